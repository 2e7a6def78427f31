"""Phrase collocation mining by SETM: relations of phrase occurrences, extended word by word.

A relation holds, for each place of the text in order, which frequent k-word phrase starts there. Two
entries at adjacent places of one piece merge into a candidate of k + 1 words; candidates are counted in
groups, and only occurrences of frequent groups are extended again:

1. ``_read`` writes the relation of single words, cut into parts of bounded size. Words are numbered within
   their part; the part's list of distinct words with counts is written beside it, one packed row a group.
2. The lists are dealt to buckets by the hash of their entries, one packed row a bucket (a shuffle of distinct entries a
   part, not of occurrences). A bucket meets its share of all lists at once: it sums them, entries below ``least`` go, the
   rest get ids, and each part is told which of its entries are among them.
3. The frequent entries of each part's own list go back to that part, where the relation is
   merge-joined with itself one place further: both are in text order, so no sort is needed. The new list is one of pairs.

Steps 2 and 3 repeat up to ``longest`` words. Every relation and every table of groups is written to the shared
folder, so a lost executor costs one step; the shuffle files of a step are given up after it. Nothing is collected to the
driver. A part holds at most ``PART`` places and one slice of a text; a longer text runs on in
the next part, which counts its own places only and sees the ``longest - 1`` words that follow.

Nulls: a null text is empty, a null group is ``und``. Repeated rows count as often as they occur. Empty texts and
tables give no phrases. Other columns are not read. Equal scores are ranked by count, then by the phrase's bytes.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.rows import _q, discard, few, full, release, shrunk, stored

LEAST, LONGEST, TOP, COVERED = 100, 5, 2_000, 100
PART = 1_500_000
#: Had told when frequent words are broadcast; callers may still give it.
SMALL = 500_000
SLICE = 1 << 22
#: Places whose words or pairs meet in one bucket, and buckets at least.
BUCKET = 1 << 21
BUCKETS = 32

#: Bytes of a text: A-Z in lower case, tab as space, piece ends as line feed. All are ASCII, so no UTF-8 sequence is touched.
_BYTES = bytes(32 if c == 9 else 10 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: A byte that UTF-8 never holds stands for the end of a piece; its number is 0.
_END = b"\xff"

_READ = "part bigint, lang string, n bigint, idx binary, words binary, counts binary, places binary"
_DEALT = "part bigint, bucket int, lang string, idx binary, words binary, counts binary"
_COUNTED_WORDS = "part bigint, bucket int, idx binary, seq binary, gid bigint, lang string, word string, a bigint"
_EXTENDED = "part bigint, bucket int, start int, n bigint, ga binary, gb binary, counts binary, places binary"
_COUNTED = "part bigint, bucket int, idx binary, seq binary, gid bigint, ga bigint, gb bigint, a bigint"



def _words(text: str, ahead: int) -> Iterator[list[bytes]]:
    """The words and piece ends of a text, in lists of bounded size; each but the last has more than ``ahead``."""
    data, start, held = text.encode("utf-8", "surrogatepass").translate(_BYTES), 0, []
    while start < len(data):
        stop = len(data)
        if stop - start > SLICE:
            stop = max(data.rfind(b" ", start, start + SLICE), data.rfind(b"\n", start, start + SLICE))
            if stop <= start:  # one word is longer than a slice
                stop = min((x for x in (data.find(b" ", start + SLICE), data.find(b"\n", start + SLICE)) if x >= 0), default=len(data))
        held += data[start:stop].replace(b"\n", b" " + _END + b" ").split()
        start = stop
        if len(held) > ahead or start == len(data):
            yield held
            held = []


class _Part:
    """Places in text order; words are numbered from 1 within the part, 0 ends a piece."""

    def __init__(self, number: int):
        self.number, self.next, self.known, self.places, self.size = number, count(1), {}, [], 0

    def add(self, lang: str, words: list[bytes]) -> None:
        if lang not in self.known:
            self.known[lang] = defaultdict(self.next.__next__, {_END: 0})
        self.places.append(np.fromiter(map(self.known[lang].__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def rows(self, lang: str, following: list[bytes]) -> Iterator[pa.RecordBatch]:
        own = self.size
        self.add(lang, following)
        places = np.concatenate(self.places)
        n = np.bincount(places[:own], minlength=next(self.next))
        yield _batch(_READ, 1, part=self.number, n=[own], places=[shrunk(places)])
        for lang, known in self.known.items():
            del known[_END]
            if known:
                idx = np.fromiter(known.values(), np.int32, len(known))
                yield _batch(_READ, 1, part=self.number, lang=lang, n=[n[idx].sum()], idx=[shrunk(idx)], words=[_joined(known)], counts=[shrunk(n[idx].astype(np.int32))])


def _joined(words: Iterable[bytes]) -> bytes:
    """Words as compressed bytes; none has a line feed."""
    return shrunk(np.frombuffer(b"\n".join(words), np.uint8))


def _split(data: bytes) -> list[bytes]:
    return full(data, np.uint8).tobytes().split(b"\n")


def _cuts(bucket: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal numbers."""
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return list(zip(first.tolist(), np.append(first[1:], len(bucket)).tolist(), strict=True))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _batch(ddl: str, rows: int, **columns) -> pa.RecordBatch:
    """A batch with single values repeated and missing columns null."""

    def column(field: pa.Field) -> pa.Array:
        got = columns.get(field.name)
        return pa.array(got, field.type) if isinstance(got, (list, np.ndarray, pa.Array)) else pa.repeat(pa.scalar(got, field.type), rows)

    schema = _schema(ddl)
    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)


def _read(ahead: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        part = _Part(next(numbers))
        for batch in few(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lists = _words(text, ahead)
                words = next(lists, None)
                while words is not None:
                    part.add(lang, words)
                    following = next(lists, None)
                    if part.size >= size:
                        yield from part.rows(lang, (following or [])[:ahead])
                        part = _Part(next(numbers))
                    if following is None:
                        part.add(lang, [_END])
                    words = following
        if part.size:
            yield from part.rows("", [])

    return run


def _dealt(buckets: int):
    """Lists of words, cut by the hash of the words: a row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                words, idx, n = _split(row["words"]), full(row["idx"], np.int32), full(row["counts"], np.int32)
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
                order = np.argsort(bucket, kind="stable")
                words, idx, n, bucket = [words[x] for x in order.tolist()], idx[order], n[order], bucket[order]
                cuts = _cuts(bucket)
                lists = {"idx": [shrunk(idx[s:e]) for s, e in cuts], "words": [_joined(words[s:e]) for s, e in cuts], "counts": [shrunk(n[s:e]) for s, e in cuts]}
                yield _batch(_DEALT, len(cuts), part=row["part"], lang=row["lang"], bucket=bucket[[s for s, _ in cuts]].astype(np.int32), **lists)

    return run


def _counted_words(least: int):
    """Of one bucket the words of ``least`` occurrences or more in all parts, with new ids; and for each part the numbers of
    its entries that are among them."""

    def run(table: pa.Table) -> pa.Table:
        bucket, number = table["bucket"][0].as_py(), count()
        known = {lang: defaultdict(number.__next__) for lang in table["lang"].unique().to_pylist()}
        at = []
        for lang, words in zip(table["lang"].to_pylist(), table["words"].to_pylist(), strict=True):
            words = _split(words)
            at.append(np.fromiter(map(known[lang].__getitem__, words), np.int32, len(words)))
        n = np.concatenate([full(x, np.int32) for x in table["counts"].to_pylist()])
        a = np.bincount(np.concatenate(at), weights=n).astype(np.int64)  # exact up to 2^53
        enough = a >= least
        seq = (np.cumsum(enough) - 1).astype(np.int32)
        out, goes_on = [], enough.tolist()
        for lang, own in known.items():
            mine = np.fromiter(own.values(), np.int32, len(own))
            mine = mine[enough[mine]]
            words = [w for w, x in own.items() if goes_on[x]]
            out.append(_batch(_COUNTED_WORDS, len(mine), gid=(bucket << 32) + seq[mine].astype(np.int64), lang=lang, word=pa.array(words, pa.binary()).cast(pa.string()), a=a[mine]))
        for part, idx, x in zip(table["part"].to_pylist(), table["idx"].to_pylist(), at, strict=True):
            mine = np.flatnonzero(enough[x])
            if len(mine):
                out.append(_batch(_COUNTED_WORDS, 1, part=part, bucket=bucket, idx=[shrunk(full(idx, np.int32)[mine])], seq=[shrunk(seq[x[mine]])]))
        return pa.Table.from_batches(out, _schema(_COUNTED_WORDS))

    return run


def _extend(relation: pa.Table, idx: np.ndarray, gid: np.ndarray, buckets: int) -> pa.Table:
    """One part's relation merge-joined with itself one place further, for places where frequent groups start; its list of pairs
    is numbered bucket by bucket."""
    places = full(relation["places"][0].as_py(), np.int32)
    own, part = relation["n"][0].as_py(), relation["part"][0].as_py()
    order = np.argsort(gid)
    idx, gid = idx[order], gid[order]
    base = len(idx) + 1
    rank = np.zeros(max(places.max(initial=0), idx.max(initial=0)) + 1, np.int32)
    rank[idx] = np.arange(1, base)
    here = rank[places]
    both = np.flatnonzero((here[:-1] > 0) & (here[1:] > 0)).astype(np.int32)
    pairs = here[both].astype(np.int64)
    pairs *= base
    pairs += here[both + 1]
    del here, rank
    keys, at = np.unique(pairs, return_inverse=True)
    del pairs
    if not len(keys):
        return _schema(_EXTENDED).empty_table()
    n = np.bincount(at[: np.searchsorted(both, own)], minlength=len(keys))
    ga, gb = gid[keys // base - 1], gid[keys % base - 1]
    mixed = ga.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ gb.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    bucket = ((mixed ^ mixed >> np.uint64(29)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(1, len(order) + 1, dtype=np.int32)
    longer = np.zeros(len(places), np.int32)
    longer[both] = number[at]
    del at, both, number, mixed
    ga, gb, n, bucket = ga[order], gb[order], n[order].astype(np.int32), bucket[order]
    cuts = _cuts(bucket)
    first = np.array([s for s, _ in cuts])
    lists = {
        "ga": [shrunk(np.diff(ga[s:e], prepend=0)) for s, e in cuts],  # in order within a bucket
        "gb": [shrunk(gb[s:e]) for s, e in cuts],
        "counts": [shrunk(n[s:e]) for s, e in cuts],
    }
    found = [_batch(_EXTENDED, 1, part=part, n=[own], places=[shrunk(longer)])]
    found.append(_batch(_EXTENDED, len(cuts), part=part, bucket=bucket[first].astype(np.int32), start=(first + 1).astype(np.int32), **lists))
    return pa.Table.from_batches(found, _schema(_EXTENDED))


def _counted(least: int, last: bool):
    """Of one bucket the pairs of ``least`` occurrences or more in all parts, with new ids; and unless it is the ``last``
    step, for each part the numbers of its entries that are among them."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        ga = [np.cumsum(full(x, np.int64)) for x in table["ga"].to_pylist()]
        ends = np.cumsum([len(x) for x in ga])
        gb, n = (np.concatenate([full(x, kind) for x in table[name].to_pylist()]) for name, kind in (("gb", np.int64), ("counts", np.int32)))
        begins, ra = np.unique(np.concatenate(ga), return_inverse=True)
        rests, key = np.unique(gb, return_inverse=True)
        del ga, gb
        key += ra * len(rests)
        del ra
        keys, at = np.unique(key, return_inverse=True)
        del key
        a = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)  # exact up to 2^53
        enough = a >= least
        seq = (np.cumsum(enough) - 1).astype(np.int32)
        keys, a = keys[enough], a[enough]
        gid = (bucket << 32) + np.arange(len(keys), dtype=np.int64)
        out = [_batch(_COUNTED, len(keys), gid=gid, ga=begins[keys // len(rests)], gb=rests[keys % len(rests)], a=a)]
        for part, start, s, e in () if last else zip(table["part"].to_pylist(), table["start"].to_pylist(), (ends - np.diff(ends, prepend=0)).tolist(), ends.tolist(), strict=True):
            mine = np.flatnonzero(enough[at[s:e]])
            if len(mine):
                out.append(_batch(_COUNTED, 1, part=part, bucket=bucket, idx=[shrunk((mine + start).astype(np.int32))], seq=[shrunk(seq[at[s:e][mine]])]))
        return pa.Table.from_batches(out, _schema(_COUNTED))

    return run


def _extend_part(buckets: int):
    """The relation of a part with its frequent entries, packed by bucket."""

    def run(relation: pa.Table, frequent: pa.Table) -> pa.Table:
        if not relation.num_rows or not frequent.num_rows:
            return _schema(_EXTENDED).empty_table()
        idx = np.concatenate([full(x, np.int32) for x in frequent["idx"].to_pylist()])
        gid = np.concatenate([full(x, np.int32) + (b << 32) for x, b in zip(frequent["seq"].to_pylist(), frequent["bucket"].to_numpy().astype(np.int64), strict=True)])
        return _extend(relation, idx, gid, buckets)

    return run


def frequent_phrases(docs: DataFrame, *, text: str = "text", group: str = "lang", least: int = LEAST, longest: int = LONGEST, part: int = PART, small: int = SMALL) -> tuple[list[DataFrame], DataFrame]:
    """Tables of frequent phrases, by number of words, and the number of all words of each group (lang, n).

    A table has gid, lang, phrase, word (the last one), a (occurrences), first (occurrences of the first 1, 2, ... words)
    and last (of the last 1, 2, ... words). ``small`` has no effect any more.
    """
    rows = docs.select(F.coalesce(F.col(_q(group)).cast("string"), F.lit("und")), F.coalesce(F.col(_q(text)).cast("string"), F.lit("")))
    now = stored(rows.mapInArrow(_read(longest - 1, part), _READ), compression="zstd")
    totals = stored(now.where("words is not null").groupBy("lang").agg(F.sum("n").alias("n")))
    none = F.array().cast("array<bigint>")
    buckets = max(BUCKETS, (totals.agg(F.sum("n").alias("n")).first()["n"] or 0) // BUCKET)
    tables = []
    for k in range(1, longest + 1):
        if k == 1:
            lists = now.where("words is not null").select("part", "lang", "idx", "words", "counts").mapInArrow(_dealt(buckets), _DEALT)
            counted = lists.groupBy("bucket").applyInArrow(_counted_words(least), _COUNTED_WORDS)
        else:
            lists = now.where("bucket is not null").select("part", "bucket", "start", "ga", "gb", "counts")
            counted = lists.groupBy("bucket").applyInArrow(_counted(least, k == longest), _COUNTED)
        counted = stored(counted, compression="zstd")  # written before its ids are used: ids of a second run could differ
        del lists
        release(docs.sparkSession)  # the lists' shuffle files
        found = counted.where("gid is not null")
        if k == 1:
            found = found.withColumns({"phrase": F.col("word"), "first": none, "last": none, "ga": F.lit(None).cast("bigint"), "gb": F.lit(None).cast("bigint")})
        else:
            a = tables[-1].select(F.col("gid").alias("ga"), "lang", F.col("phrase").alias("begin"), F.concat("first", F.array("a")).alias("first"))
            b = tables[-1].select(F.col("gid").alias("gb"), "word", F.concat("last", F.array("a")).alias("last"))
            found = found.select("gid", "ga", "gb", "a").join(a, "ga").join(b, "gb").withColumn("phrase", F.concat_ws(" ", "begin", "word"))
        tables.append(stored(found.select("gid", "ga", "gb", "lang", "phrase", "word", "a", "first", "last")))
        before = [now, counted]
        if k < longest:
            kept = counted.where("part is not null").select(F.col("part").alias("into"), "bucket", "idx", "seq")
            del found
            release(docs.sparkSession)
            relation = now.where("places is not null").select("part", "n", "places")
            now = stored(relation.groupBy("part").cogroup(kept.groupBy("into")).applyInArrow(_extend_part(buckets), _EXTENDED), compression="zstd")
            del relation, kept
        for x in before:
            discard(x)
        release(docs.sparkSession)
    return tables, totals


def collocations(
    docs: DataFrame, *, text: str = "text", group: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED, part: int = PART, small: int = SMALL
) -> DataFrame:
    """The ``top`` phrases of each group by score: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words that occurs ``least`` times or more is cut in two at each place; its score is that of
    the cut with the least floor(1000 * a * n / (l * r)), the first of equal ones. A phrase inside a longer one that has
    at least ``covered`` percent of its occurrences goes. Products are decimals of 38 digits and the quotient is whole.
    """
    tables, totals = frequent_phrases(docs, text=text, group=group, least=least, longest=longest, part=part, small=small)
    out = []
    for k, table in enumerate(tables[1:], 2):
        if k < longest:
            # a longer phrase that holds this one holds it in one that is longer by a word, and occurs no more often
            longer = reduce(DataFrame.unionAll, [tables[k].select(F.col(x).alias("gid"), F.col("a").alias("more")) for x in ("ga", "gb")])
            table = table.join(longer.groupBy("gid").agg(F.max("more").alias("more")), "gid", "left")
            table = table.where(F.col("more").isNull() | (100 * F.col("more") < covered * F.col("a")))
        out.append(table.select("lang", "phrase", "a", "first", "last"))
    found = reduce(DataFrame.unionAll, out).join(totals, "lang")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = found.select("*", F.posexplode(F.arrays_zip(F.col("first").alias("l"), F.reverse("last").alias("r"))).alias("k", "cut")).select("*", "cut.l", "cut.r")
    cuts = cuts.withColumn("over", F.expr("cast(1000 * a as decimal(19,0))") * whole("n")).withColumn("under", whole("l") * whole("r"))
    cuts = cuts.withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, row_number() OVER () AS piece, regexp_split_to_array(piece, '[\x20\x09]+') AS w FROM pieces),
words AS (
  SELECT lang, piece, i, word
  FROM (SELECT lang, piece, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM lists) WHERE word <> ''),
rows_of_five AS (
  SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4, lead(word, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)),
f AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM rows_of_five GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 AS p, count(*) FROM rows_of_five WHERE w2 IS NOT NULL GROUP BY lang, p HAVING count(*) >= 100
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 AS p, count(*) FROM rows_of_five WHERE w3 IS NOT NULL GROUP BY lang, p HAVING count(*) >= 100
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 AS p, count(*) FROM rows_of_five WHERE w4 IS NOT NULL GROUP BY lang, p HAVING count(*) >= 100
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 AS p, count(*) FROM rows_of_five WHERE w5 IS NOT NULL GROUP BY lang, p HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inner_phrases AS (
  SELECT lang, a AS more, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM candidates, (SELECT unnest(range(2, 5)) AS size), (SELECT unnest(range(1, 5)) AS i)
  WHERE size < k AND i + size - 1 <= k),
kept AS (
  SELECT c.* FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM inner_phrases x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.more >= 100 * c.a)),
halves AS (
  SELECT c.lang, c.phrase, c.a, j, array_to_string(c.w[1:j], ' ') AS begin, array_to_string(c.w[j + 1:], ' ') AS rest
  FROM kept c, (SELECT unnest(range(1, 5)) AS j) WHERE j < c.k),
cuts AS (
  SELECT h.lang, h.phrase, h.a, j, x.a AS l, y.a AS r, t.n, ((1000 * h.a::HUGEINT * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.begin JOIN f y ON y.lang = h.lang AND y.phrase = h.rest JOIN totals t ON t.lang = h.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
