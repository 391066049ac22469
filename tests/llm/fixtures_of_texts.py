"""Texts with the oddities that the operators must bear."""

ODD_TEXTS = [
    None, "", " ", "  a  b ", "\n\n\n", "a\n b\n\nc", "\tx\t\ty \tz", "it's we'LL 'tis 123 45,6 don't", "ÀÉ ẞß ſ K İstanbul ΣΑΣ", "é ́x 𝔘𝔫𝔦 😀😀", "▁x y▁ z",
    "<|endoftext|> x <|startoftext|>y </s><0x0A>", "\x00 \x02a \x02b \x1c c", "a\xa0 b c", "x" * 3000, "ab " * 2000, "word,\nWORD!? word...", "+1 (743) 555-3824 19@mail5.example.com",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, spans string, part int, fingerprint string, score double"


def documents(spark, texts=ODD_TEXTS, repeat=1):
    """Documents with extra columns that share names with results; ``repeat`` copies of every row, keys kept."""
    rows = [(i, text, None if i % 3 else "en", "s", None, 7, "no", 1, "f", 0.5) for i, text in enumerate(texts)] * repeat
    return spark.createDataFrame(rows, SCHEMA)
