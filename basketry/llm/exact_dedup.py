"""Exact duplicates by recipes of content-defined chunks, with DataFrame functions only.

A text is cut after a line end, or after a sentence whose next one begins with a letter of a fixed
quarter, from ``LEAST`` characters on; without such a place it is cut at ``MOST``. Cuts depend on the
text around them alone, so texts that share passages share chunks. A chunk's identifier is its hash
plus, where several chunks have one hash, its number among them: all distinct chunks are compared
byte by byte to find these. A document's recipe is the ordered list of its identifiers; recipes are
equal exactly if the texts are. Distinct chunks are shuffled once; whole documents never are.

Defined results: null text counts as empty, and empty texts equal each other; of equal texts the row
with the largest doc_id stays, null being the smallest, and of rows that repeat the doc_id too just
one; text that is not valid UTF-8 is one chunk; very long texts are cut like others; an empty table
gives no rows; other columns are ignored, and travel along in ``deduplicated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.words import unused
from basketry.session import stored

LEAST, MOST = 256, 4096
CUT = r"\n|[.!?。！？] ?(?=[A-Fa-f])"
HASH_BITS = 64


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text in pieces, in order and without gaps."""
    pattern = f"(?s).{{{least},{most - 1}}}?(?:{CUT})|(?s).{{1,{most}}}"
    return F.when(F.is_valid_utf8(text), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array(text))


def hashed(chunk: Column, bits: int = HASH_BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits) if bits < 64 else F.xxhash64(chunk)


def chunk_table(documents: DataFrame, bits: int = HASH_BITS) -> DataFrame:
    """Every distinct chunk once, with its hash; compared byte by byte."""
    chunk = F.explode(chunks(F.coalesce("text", F.lit("")))).alias("chunk")
    return documents.select(chunk).select(hashed(F.col("chunk"), bits).alias("hash"), "chunk").distinct()


def recipes(documents: DataFrame, bits: int = HASH_BITS) -> DataFrame:
    """row, doc_id, hashes, numbers and text_sha256 of every row.

    ``numbers`` tells apart, in order, those chunks of the text whose hash other chunks have too.
    """
    text = F.coalesce("text", F.lit(""))
    hashes = F.transform(chunks(text), lambda c: hashed(c, bits)).alias("hashes")
    digest = F.sha2(text, 256).alias("text_sha256")
    if "row" not in documents.columns:
        documents = documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    table = chunk_table(documents, bits)
    shared = stored(table.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "shared-hashes")
    if shared.isEmpty():
        none = F.array().cast("array<int>").alias("numbers")
        return stored(documents.select("doc_id", "row", hashes, digest, none), "recipes")
    documents = stored(documents.select("doc_id", "text", "row"), "numbered")
    order = Window.partitionBy("hash").orderBy("chunk")
    clashing = table.join(shared, "hash", "left_semi").withColumn("number", F.row_number().over(order))
    places = documents.select(F.col("row").alias("of"), F.posexplode(chunks(text)).alias("pos", "chunk"))
    places = places.withColumn("hash", hashed(F.col("chunk"), bits)).join(clashing, ["hash", "chunk"])
    told = places.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("pos", "number"))).alias("told"))
    found = documents.select("doc_id", "row", hashes, digest).join(told, F.col("row") == F.col("of"), "left")
    numbers = F.coalesce("told.number", F.array().cast("array<int>")).alias("numbers")
    return stored(found.select("doc_id", "row", "hashes", "text_sha256", numbers), "recipes")


def verdicts(documents: DataFrame, bits: int = HASH_BITS) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    found = recipes(documents, bits)
    recipe = ["hashes", "numbers"]
    stays = F.max(F.struct("doc_id", "row")).alias("stays")
    # A written table, so that the join below may split a large group's rows.
    groups = stored(found.groupBy(*recipe).agg(stays, F.count("*").alias("group_size")), "groups")
    return found.join(groups, recipe).select(
        "row", "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256",
    )


def duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    return verdicts(documents.select("doc_id", "text")).drop("row")


def deduplicated(documents: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns. The table is written once, to number its rows."""
    own = unused(documents.columns, "dedup_row")
    numbered = stored(documents.withColumn(own, F.monotonically_increasing_id()), "numbered")
    keys = numbered.select("doc_id", "text", F.col(own).alias("row"))
    kept = verdicts(keys).where("kept").select(F.col("row").alias(own))
    return numbered.join(kept, own, "left_semi").drop(own)
