"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so: after at least `SMALLEST` characters at the next letter-and-blank mark, after
`LARGEST` at the latest, so equal passages give equal chunks wherever they stand. Chunks are moved once, combined on the
map side, to give every chunk text an identifier that is verified: a 64-bit hash, plus a number wherever two different
chunk texts have the same hash. A document is then its recipe, the ordered list of identifiers; recipes are compared in
place of texts. Texts are equal exactly when their recipes are.

Defined results: null counts as empty; all empty texts are one group; of equal texts the row with the largest doc_id
stays, null ids lose to others; rows that repeat an id share it as keep_id, and all of them count in group_size; of rows
that tie on the kept id in `kept_documents` one stays; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import numbered, stored

SMALLEST, LARGEST = 768, 8192
#: Cut after one of these letters and a blank or line end; what follows the largest size is cut anyway.
_CHUNK = rf"(?s).{{{SMALLEST},{LARGEST}}}?(?<=[enrst][,.]?[ \n])|.{{1,{LARGEST}}}"


def chunks(text: str | Column) -> Column:
    """The text in order, cut into chunks; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0))


def chunk_hash(chunk: Column, bits: int = 64) -> Column:
    """`bits` below 64 makes hashes clash often, for tests of the verified numbers."""
    h = F.xxhash64(chunk)
    return h if bits == 64 else F.shiftrightunsigned(h, 64 - bits)


def _different_chunks(docs: DataFrame, bits: int) -> DataFrame:
    rows = docs.select(F.explode(chunks(F.coalesce("text", F.lit("")))).alias("chunk"))
    return rows.select(chunk_hash(F.col("chunk"), bits).alias("hash"), "chunk").distinct()


def clashing_hashes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Hashes that different chunk texts have. Chunks move once; after that only hashes do."""
    return _different_chunks(docs, bits).groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("hash")


def clashes(docs: DataFrame, hashes: DataFrame, bits: int = 64) -> DataFrame:
    """(hash, chunk, number): the chunk texts of each of the hashes, numbered from 0."""
    texts = _different_chunks(docs, bits).join(hashes, "hash", "left_semi")
    return texts.groupBy("hash").agg(F.collect_list("chunk").alias("same")).select("hash", F.posexplode(F.array_sort("same")).alias("number", "chunk"))


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, text_sha256, recipe: one identifier list per row of `docs`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes = F.transform(chunks(text), lambda c: chunk_hash(c, bits))
    plain = docs.select("doc_id", F.sha2(text, 256).alias("text_sha256"), hashes.alias("recipe"))
    shared = stored(clashing_hashes(docs, bits))
    if shared.isEmpty():  # every hash stands for one chunk text: hashes are the identifiers
        return plain
    same = stored(clashes(docs, shared, bits))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    pieces = rows.select("row", F.posexplode(chunks("text")).alias("pos", "chunk"))
    pieces = pieces.withColumn("hash", chunk_hash(F.col("chunk"), bits)).join(same, ["hash", "chunk"])
    extra = pieces.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "number"))).alias("numbers"))
    whole = F.transform(F.coalesce("numbers", F.array()), lambda x: x["pos"].cast("long") * (1 << 31) + x["number"])
    both = rows.join(extra, "row", "left").withColumn("hashes", F.transform(chunks("text"), lambda c: chunk_hash(c, bits)))
    return both.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.concat(F.array(F.size("hashes").cast("long")), "hashes", whole).alias("recipe"))


def groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; one row of each group is kept."""
    rows = stored(recipes(docs, bits).withColumn("row", F.monotonically_increasing_id()))
    found = rows.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
    # A recipe of one row needs no join; the others are joined by recipe, where Spark may split a large group.
    out = rows.join(stored(found.where(F.col("n") > 1)), "recipe", "left")
    alone = F.col("n").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("keep.row"))).alias("kept"), "text_sha256",
    )


def kept_documents(docs: DataFrame, bits: int = 64) -> DataFrame:
    """The documents that stay, one for each text, with all their columns, whatever their names."""
    found = stored(groups(docs, bits))
    key = [F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")]
    every, names = numbered(docs)
    doc_id, text = F.col(names["doc_id"]), F.col(names["text"])
    same = doc_id.eqNullSafe(F.col("id")) & (F.sha2(F.coalesce(text, F.lit("")), 256) == F.col("sha"))
    rows = every.join(found.where("kept").select(*key), same, "left_semi")
    repeated = stored(found.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*key).distinct())
    if not repeated.isEmpty():
        # Rows that repeat both id and text: one of each stays.
        once = rows.join(repeated, same, "left_semi").groupBy(doc_id, text).agg(F.first(F.struct(*names.values())).alias("row"))
        rows = rows.join(repeated, same, "left_anti").unionByName(once.select("row.*"))
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])
