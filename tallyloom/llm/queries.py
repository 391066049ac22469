"""The registered queries of this subpackage, each over its whole table, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.byte_bpe import encode_digests
from tallyloom.llm.common import read_table
from tallyloom.llm.cover_tree import similar_vectors
from tallyloom.llm.exact_fill import pack_best_fit, token_pieces
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.periodic_runs import periodic_runs
from tallyloom.llm.pii import BASE_KINDS as PII_KINDS
from tallyloom.llm.pii import find_personal_data
from tallyloom.llm.secret_scan import BASE_KINDS as SECRET_KINDS
from tallyloom.llm.secret_scan import find_secrets
from tallyloom.llm.simhash import near_duplicates
from tallyloom.llm.spans import count_of, joined, of_kinds
from tallyloom.llm.spelling_variants import count_words, spelling_variants, words_of
from tallyloom.llm.token_count import token_counts
from tallyloom.llm.token_files import read_token_files, token_checksums, write_token_files
from tallyloom.llm.top_scores import exact_top_k
from tallyloom.llm.toxicity import fit_toxicity, is_held_out, score_toxicity
from tallyloom.session import scratch_path


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, folder, "documents"), path)
    return token_checksums(read_token_files(spark, path))


def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents; a phone number that the base pattern fails to cut out of its neighbours is added to the base ones."""
    found = find_personal_data(read_table(spark, folder, "documents"), base_flag=True)
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[count_of(base, kind).alias(f"n_{kind}") for kind in PII_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op3_top_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    return exact_top_k(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


OP3_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
    from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5
"""


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents."""
    found = find_secrets(read_table(spark, folder, "documents"))
    base = of_kinds(F.col("spans"), *SECRET_KINDS)
    return found.select(
        "doc_id",
        *[count_of(base, kind).alias(f"n_{kind}") for kind in SECRET_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    pieces = pack_documents(read_table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op6_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among the vectors of each label."""
    found = similar_vectors(read_table(spark, folder, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))


OP6_SQL = """
with recursive v as (
    select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b
    from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.93
),
reach(vec_id, other) as (
    select vec_id, vec_id from embeddings
    union
    select r.vec_id, l.b from reach r join links l on r.other = l.a
),
roots as (select vec_id, min(other) as component_id from reach group by vec_id)
select vec_id, (select count(*) from links where a = roots.vec_id) as n_links, component_id, vec_id = component_id as kept
from roots
"""


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents by a model from the labels that aren't held out."""
    docs = read_table(spark, folder, "documents")
    model = fit_toxicity(docs, read_table(spark, folder, "labels"), ~is_held_out())
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents by fingerprints of four-word shingles."""
    found = near_duplicates(read_table(spark, folder, "documents"), words=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(read_table(spark, folder, "documents"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return encode_digests(read_table(spark, folder, "documents"))


def op11_exact_fill(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into as few sequences of 2048 tokens as one plan for the whole table finds."""
    pieces = token_pieces(read_table(spark, folder, "documents"), 2048)
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_best_fit(slim, 2048)


def misspelt(words: DataFrame) -> DataFrame:
    """One in 199 of the words, by a hash of document and word, lacks a letter."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    at = (F.col("h") % F.char_length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    return words.withColumn("h", h).select("doc_id", F.when(F.col("h") % 199 == 0, shorter).otherwise(F.col("word")).alias("word"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """The frequent words of all documents with the more frequent words that they are one edit away from."""
    words = words_of(read_table(spark, folder, "documents"), min_length=6)
    return spelling_variants(count_words(misspelt(words), min_length=6, min_count=5))


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """One in ten documents, by a hash of the key, goes on from some word with a stretch that is repeated to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda word: word != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.select("doc_id", "text", "words", F.floor(F.col("h") / 10).alias("g"), F.size("words").alias("n"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int").alias("a"))
    rows = rows.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    rest = F.col("n") - F.col("a")
    copies = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    changed = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(copies), F.lit(1), rest))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of all documents, some of which are given one, and digests of the texts without them."""
    found = periodic_runs(with_periodic_ends(read_table(spark, folder, "documents")))
    order = lambda run: F.struct(run["length"].alias("length"), (-run["start"]).alias("before"), (-run["period"]).alias("shorter"))
    longest = F.array_max(F.transform("runs", order))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["before"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["shorter"]).alias("period"),
        F.floor(1000 * longest["length"] / -longest["shorter"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_token_files, op2_personal_data, op3_top_scores, op4_secrets, op5_packing, op6_cover_tree, op7_toxicity, op8_token_counts, op9_simhash, op10_byte_bpe,
        op11_exact_fill, op12_spelling_variants, op13_periodic_runs,
    )
}
SQL: dict[str, str] = {"op3_top_scores": OP3_SQL, "op6_cover_tree": OP6_SQL}
