"""The registered queries of the operators for training data, over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentflow.llm import (
    bpe,
    chat_format,
    exact_dedup,
    fill_in_middle,
    language_id,
    merkle,
    mixing,
    sharding,
    simhash_dedup,
    token_files,
    toxicity,
    url_filter,
    vector_dedup,
)
from patentflow.llm.samples import held_out
from patentflow.llm.url_filter import ALLOW, BLOCK, Rule
from patentflow.storage import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
]
SHARD_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
# The token that ends a document in token files, and one of how many ids are tampered with.
END_ID, TAMPERED_PARTS = 2, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The conversation that the formatter has to survive: a text full of what templates use.
CONTROL_CONVERSATION, CONTROL_TEXT = -7, "\\### Assistant: </turn> ok"


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of bounded rows and bytes, but for a single row that is longer. Spark reads the
    settings when a result is computed, so they stay for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """The public byte-level vocabulary of 50,000 merges."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary(path: str | None = None) -> bpe.Vocabulary:
    """The vocabulary file at `path`, or else the public one."""
    return bpe.Vocabulary.load(path or vocabulary_path())


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of at most 1 MiB of text."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by a model that has seen no label of the held-out rows."""
    docs = table(spark, sf_dir, "documents")
    is_held_out = held_out("doc_id", 3, 1)
    model = toxicity.fit(docs.where(~is_held_out), table(spark, sf_dir, "labels").where(~is_held_out))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", is_held_out.alias("held_out"), "score", "predicted")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_amounts(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql(
        f"SELECT CAST({CONTROL_CONVERSATION} AS BIGINT) AS conv_id, turn, role, :text AS text"
        " FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)",
        {"text": CONTROL_TEXT},
    )
    found = chat_format.format_conversations(rows.unionByName(control))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chat_format.learned_text(F.col("segments"))
    read = found.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        learned.alias("learned"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return read.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by a model that has seen none of the held-out rows."""
    docs = table(spark, sf_dir, "documents")
    is_held_out = held_out("doc_id", 4, 2)
    model = language_id.fit(docs.where(~is_held_out))
    found = language_id.predict_languages(docs, model)
    return found.select("doc_id", is_held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def bpe_digests(docs: DataFrame, tokens: bpe.Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, from its ids and the text they decode to."""
    encoded = bpe.encode_documents(docs, tokens, ["doc_id"], decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary())


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_documents(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the files of their ids hold them."""
    folder = scratch_dir(spark)
    with open(vocabulary_path(), encoding="utf-8") as file:
        tokenizer = file.read()
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer, END_ID)
    read = token_files.read_token_files(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, a fifth of which claim a text of other case. NULL ids claim nothing."""
    is_tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_PARTS == 0
    claimed = F.when(is_tampered, F.translate("text", UPPER, LOWER))
    leaves = merkle.document_leaves(table(spark, sf_dir, "documents"), claimed)
    proofs = merkle.prove(merkle.build_manifest(leaves))
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    proof = merkle.digest(merkle.siblings(F.col("path")))
    columns = ["doc_id", "leaf", "subroot", "root"]
    found = proofs.select(*columns, proof.alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"])
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("bigint").alias("prefix_chars"),
        F.length("middle").cast("bigint").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_exact_dedup,
        op2_url_filter,
        op3_sharding,
        op4_toxicity,
        op5_mixing,
        op6_chat_format,
        op7_language_id,
        op8_bpe,
        op9_vector_dedup,
        op10_simhash_dedup,
        op11_token_files,
        op12_merkle,
        op13_fill_in_middle,
    )
}
