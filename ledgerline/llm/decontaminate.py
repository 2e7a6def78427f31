"""Benchmark decontamination: a prefix-filtered set join of shingles, in DataFrame operations only.

An item's windows are its runs of ``WINDOW`` words (one window if it is shorter). A window occurs only
if all its shingles do, so one of them, the rarest in the corpus, is its necessary prefix: only
places of that shingle are candidates. Length and positional bounds drop places at which the window
cannot fit, and the remaining diagonals (place minus place in the item) are verified shingle by shingle;
runs of enough consecutive matches are exact occurrences.

Shingles have ``SHINGLE`` words (as many as the item has, if fewer) and are compared as text.

Null and wordless texts have no words and no hits; null or wordless items have no windows. Items with
a null id taint documents but are not listed. Repeated documents get one result each, repeated items
count once. Empty tables give empty results or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.rows import _q, stored

WINDOW = 10
SHINGLE = 5
BROADCAST_ROWS = 500_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, lower-cased Latin letters and signs beyond ASCII; none for null."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(plain, _BREAK), "")


def _shingles(w: Column, size: int) -> Column:
    """(place, text) of every run of ``size`` words."""
    places = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)]).alias("sh")))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """With a broadcast hint if the counted rows are few; beyond that Spark shuffles both sides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame]:
    """(documents, runs): (id, text_hash, n_words) of each row, and (id, text_hash, item, start, end) in
    words of each maximal run of window occurrences of an item on one diagonal."""
    bench = items.select(F.col(_q(item_id)).alias("item"), words(F.col(_q(item_text))).alias("w")).where("size(w) > 0").distinct()
    bench = bench.withColumn("n", F.size("w")).withColumn("len", F.least(F.lit(window), "n")).withColumn("k", F.least(F.lit(shingle), "n"))
    sizes = sorted(r["k"] for r in bench.select("k").distinct().collect())  # at most ``shingle`` numbers
    parts = [
        bench.where(F.col("k") == k).select("item", "n", "len", "k", F.xxhash64("w").alias("wh"), F.explode(_shingles(F.col("w"), k)).alias("s"))
        for k in sizes
    ] or [bench.select("item", "n", "len", "k", F.xxhash64("w").alias("wh"), F.explode(_shingles(F.col("w"), 1)).alias("s"))]
    own = parts[0]
    for part in parts[1:]:
        own = own.unionByName(part)
    own = stored(own.select("item", "wh", "n", "len", "k", F.col("s.at").alias("q"), F.col("s.sh").alias("sh")))

    # one empty shingle a document matches always and brings its word count along
    known = stored(own.select("sh").union(docs.sparkSession.createDataFrame([("",)], "sh string")).distinct().withColumn("h", F.xxhash64("sh")))
    w = F.col("w")
    listed = F.concat(F.array(F.struct(F.lit(-1).alias("at"), F.lit("").alias("sh"))), *[_shingles(w, k) for k in sizes])
    rows = docs.select(F.col(_q(id_col)).alias("id"), F.xxhash64(F.col(_q(text)).cast("string")).alias("text_hash"), words(F.col(_q(text))).alias("w"))
    places = rows.select("id", "text_hash", F.size(w).alias("n_words"), F.explode(listed).alias("s")).select(
        "id", "text_hash", "n_words", F.col("s.at").alias("at"), F.col("s.sh").alias("sh"), F.xxhash64("s.sh").alias("h")
    )
    n_known = known.count()
    hits = stored(places.join(_sized(known.withColumnRenamed("sh", "known"), n_known), "h").where("sh = known").select("id", "text_hash", "n_words", "at", "sh"))
    documents = hits.where("at = -1").select("id", "text_hash", "n_words")
    hits = hits.where("at >= 0")

    # rarity, then the rarest shingle of each window that can occur at all
    counts = hits.groupBy("sh").agg(F.count("*").alias("cnt"))
    first, last = F.greatest(F.lit(0), F.col("q") - (F.col("len") - F.col("k"))), F.least(F.col("q"), F.col("n") - F.col("len"))
    ranked = own.join(counts, "sh", "left").withColumn("o", F.explode(F.sequence(first, last)))
    item_key = ["item", "wh"]
    windows = ranked.groupBy(*item_key, "n", "len", "k", "o").agg(
        F.min(F.struct(F.coalesce("cnt", F.lit(0)).alias("cnt"), "q", "sh")).alias("rare")
    )
    anchors = stored(
        windows.where("rare.cnt > 0")
        .groupBy(*item_key, "len", F.col("rare.q").alias("q"), F.col("rare.sh").alias("sh"))
        .agg(F.min("o").alias("first_o"), F.max("o").alias("last_o"))
    )
    fits = "n_words >= len and at - q + last_o >= 0 and at - q + first_o + len <= n_words"
    doc_key = ["id", "text_hash"]
    diagonals = (
        hits.join(_sized(anchors, anchors.count()), "sh").where(fits).select(*doc_key, *item_key, "n_words", (F.col("at") - F.col("q")).alias("diagonal")).distinct()
    )
    expected = diagonals.alias("d").join(
        _sized(own, n_known).alias("o"), (F.col("d.wh") == F.col("o.wh")) & F.col("d.item").eqNullSafe(F.col("o.item"))
    ).select("d.id", "text_hash", "d.item", "d.wh", "n_words", "diagonal", "len", "k", "q", "sh", (F.col("diagonal") + F.col("q")).alias("at"))
    expected = expected.where("at >= 0 and at + k <= n_words")
    seen = hits.select(F.col("id").alias("id2"), F.col("text_hash").alias("hash2"), F.col("at").alias("at2"), F.col("sh").alias("sh2")).distinct()
    same = (F.col("id").eqNullSafe(F.col("id2"))) & (F.col("text_hash") == F.col("hash2")) & (F.col("at") == F.col("at2")) & (F.col("sh") == F.col("sh2"))
    matched = expected.join(seen, same, "left_semi")
    diagonal = [*doc_key, *item_key, "diagonal"]
    numbered = matched.withColumn("island", F.col("q") - F.row_number().over(Window.partitionBy(*diagonal).orderBy("q")))
    runs = numbered.groupBy(*diagonal, "len", "k", "island").agg(F.min("q").alias("a"), F.max("q").alias("z"))
    runs = runs.where("z - a >= len - k").select(
        *doc_key, "item", (F.col("diagonal") + F.col("a")).alias("start"), (F.col("diagonal") + F.col("z") + F.col("k")).alias("end")
    )
    return documents, runs


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit (words inside occurrences), the ids of the items that
    occur as sorted strings, and whether any does."""
    documents, runs = occurrences(docs, items, id_col=id_col, **names)
    before = Window.partitionBy("id", "text_hash").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hit = runs.withColumn("new", covered).groupBy("id", "text_hash").agg(
        F.sum("new").alias("n_hit"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")
    )
    hit = hit.select(F.col("id").alias("id2"), F.col("text_hash").alias("hash2"), "n_hit", "items")
    same = F.col("id").eqNullSafe(F.col("id2")) & F.col("text_hash").eqNullSafe(F.col("hash2"))
    return documents.join(hit, same, "left").select(
        F.col("id").alias(id_col),
        "text_hash",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", **names) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    _, runs = occurrences(docs, items, text=text, id_col=id_col, **names)
    tainted = stored(runs.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    same = F.col(_q(id_col)).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(_q(text)).cast("string")) == F.col("__hash"))
    return docs.join(_sized(tainted, tainted.count()), same, "left_anti")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[o : o + least(len(w), 10) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS o FROM b WHERE len(w) > 0)),
doc_windows AS (SELECT r, p, size, array_to_string(w[p : p + size - 1], ' ') AS win
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)),
found AS (SELECT r, p, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS q FROM found) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
    FROM (SELECT DISTINCT r, cast(item_id AS varchar) AS i FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit,
    cast(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""
