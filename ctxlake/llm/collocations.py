"""Phrase collocations by marginalising counts of the longest windows.

Each word of a piece leads one window of itself and the words after it, padded with '' at the end of the piece. Only these windows are
counted; Spark's ROLLUP over the columns of a window sums them to the counts of all its prefixes, so a phrase of any shorter
length is counted without windows of its own. Windows that repeat within a chunk of text are combined in the task.

A frequent phrase holds frequent grams only, so windows end where the next pair or triple is not frequent; windows that start with a
word of no frequent pair only add to the total of their language. Earlier passes count hashes of pairs, then of triples and words of frequent
pairs, and leave a bitmap with a bit for each frequent one, of about 32 times as many bits as there are frequent pairs, ``2 ** gram_bits`` at most. Equal hashes and
a full bitmap keep more windows, never fewer: frequent phrases, their words and totals are counted exactly at every size. The bitmaps are all
that tasks are sent. Hashes travel as sorted packs of gaps, two to three bytes each.

Words are compared as text, never as hashes. Null and empty texts have no words; a null language counts as ``und``. Rows count as often as
they occur, whatever their doc_id. Texts of any length are cut into chunks that overlap by a window. Extra columns take no
part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import scratch, staged
from .common import Powers, chunks, mix, texts

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b" \t"
CHUNK = 1 << 19
HASH_BITS = 35
GRAM_BITS = 27
# Hashes are counted in ranges of their first bits. A task gathers so many before it sends them.
RANGE_BITS = 12
PACKED = 1 << 21

_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)], _KIND[list(BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Start and piece number of each word, its code, and the words by code. Words end at row ends."""
    kind = _KIND[data]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    marks = (kind == 2).astype(np.int32)
    marks[heads] += 1
    pieces = np.cumsum(marks)[starts]
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    body = _LOWER[data[inside]]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body)]).dictionary_encode()
    return starts, pieces, coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _joined(columns: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """One number a row, equal where all columns are; columns hold 0 to size - 1."""
    key, room = columns[0], sizes[0]
    for column, size in zip(columns[1:], sizes[1:]):
        if room * size >= 1 << 63:
            known, key = np.unique(key, return_inverse=True)
            room = len(known)
        key, room = key * size + column, room * size
    return key


class _Run:
    """The words of a chunk of text. Windows start at the first ``done`` words; the words after them are there to be looked at."""

    def __init__(self, langs: np.ndarray, data: np.ndarray, offsets: np.ndarray, whole: bool, margin: int):
        starts, pieces, self.words, self.codes = _words(data, offsets)
        self.done = max(0, len(starts) if whole else len(starts) - margin)
        self.next = int(starts[self.done]) if self.done < len(starts) else len(data)
        self.lang = langs[np.searchsorted(offsets, starts[: self.done], "right") - 1]
        self.linked = np.zeros(len(starts), bool)
        self.linked[:-1] = pieces[:-1] == pieces[1:]


def _runs(texts_: pa.Array, langs: np.ndarray, margin: int) -> Iterator[_Run]:
    """Runs that cover all words once; a long text comes in several, which overlap by ``margin`` words."""
    body, ends = texts(texts_)
    for row, end, data, offsets in chunks(body, ends, CHUNK):
        at, size = 0, len(data) if end - row > 1 else CHUNK
        while at < len(data):
            stop = min(at + size, len(data))
            run = _Run(langs[row:end], data[at:stop], offsets if end - row > 1 else np.array([0, stop - at]), stop == len(data), margin)
            if run.done:
                yield run
            if run.done or stop == len(data):
                at, size = at + run.next, CHUNK
            else:
                size *= 2


def _grams(run: _Run, powers: Powers, known: dict[int, np.ndarray], bits: int, length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For 1 to ``length`` words: may the gram from each word on be frequent? And the hashes of the grams.

    A gram may be if it lies in one piece, its bit is set where there is a bitmap of its length, and both grams of one word
    less may be.
    """
    n = len(run.codes)
    body, at = texts(run.words)
    one = powers.spans(body.astype(np.uint64) + np.uint64(1), at[:-1], at[1:])[run.codes]
    hashes, may, mays, every = one, np.ones(n, bool), [], []
    for size in range(1, length + 1):
        if size > 1:
            hashes, before = mix(hashes[: max(0, n - size + 1)] * np.uint64(0x9E3779B97F4A7C15) + one[size - 1 :]), may
            may = np.zeros(n, bool)
            may[: len(hashes)] = before[: len(hashes)] & before[1 : len(hashes) + 1]
        if size == 2:
            may &= run.linked
        if size in known:
            bit = hashes >> np.uint64(64 - bits)
            may[: len(hashes)] &= (known[size][bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        mays.append(may.copy())
        every.append(hashes)
    return mays, every


def _packs(hashes: np.ndarray, least: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Range, hashes and counts of each range that has some. Three bytes of a gap lie apart, for most of the last are zero.

    Counts go up to ``least``: a sum that reaches it does so with these as well.
    """
    grams, counts = np.unique(hashes, return_counts=True)
    low = HASH_BITS - RANGE_BITS
    at = np.searchsorted(grams >> np.uint64(low), np.arange((1 << RANGE_BITS) + 1, dtype=np.uint64))
    within = (grams & np.uint64((1 << low) - 1)).astype(np.int64)
    gaps = np.diff(within, prepend=0)
    heads = at[:-1][at[:-1] < at[1:]]
    gaps[heads] = within[heads]
    planes = gaps.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    counts = np.minimum(counts, least)
    for k in np.flatnonzero(at[:-1] < at[1:]).tolist():
        rows = slice(at[k], at[k + 1])
        yield k, planes[rows].T.tobytes(), counts[rows].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(pack: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes within their range, and their counts."""
    planes = np.frombuffer(pack, np.uint8).reshape(3, -1).astype(np.int64)
    sums = np.frombuffer(counts, np.uint8).reshape(4, -1).astype(np.int64)
    return np.cumsum(planes[0] | planes[1] << 8 | planes[2] << 16), sums[0] | sums[1] << 8 | sums[2] << 16 | sums[3] << 24


def _gram_packs(lengths: list[int], bitmaps: dict[int, bytes], bits: int, least: int):
    """Hashes of the grams of ``lengths`` words that may be frequent, gathered over the texts of a task.

    Words are those of pairs that may be, once for each such pair that they start or end: as often as a pair, at least.
    """
    longest = max(2, *lengths)

    def sent(length: int, hashes: list[np.ndarray]) -> pa.RecordBatch:
        ranges, packs, counts = zip(*_packs(np.concatenate(hashes), least))
        columns = [pa.array([length] * len(ranges), pa.int32()), pa.array(ranges, pa.int32()), pa.array(packs, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["length", "range", "pack", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, known = Powers(0x5851F42D4C957F2D), {k: np.frombuffer(b, np.uint8) for k, b in bitmaps.items()}
        held: dict[int, list[np.ndarray]] = {length: [] for length in lengths}
        for batch in batches:
            for part in _runs(batch.column(0), np.zeros(batch.num_rows, np.int64), longest):
                may, every = _grams(part, powers, known, bits, longest)
                for length in lengths:
                    at = np.flatnonzero(may[max(2, length) - 1][: part.done])
                    hashes = every[length - 1][np.concatenate((at, at + 1)) if length == 1 else at]
                    if len(hashes):
                        held[length].append(hashes >> np.uint64(64 - HASH_BITS))
                    if sum(map(len, held[length])) >= PACKED:
                        yield sent(length, held[length])
                        held[length] = []
        for length, hashes in held.items():
            if hashes:
                yield sent(length, hashes)

    return run


def _frequent(least: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        found = [_unpacked(*row) for row in zip(group["pack"].to_pylist(), group["counts"].to_pylist())]
        grams, where = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        sums = np.zeros(len(grams), np.int64)
        np.add.at(sums, where, np.concatenate([f[1] for f in found]))
        grams = grams[sums >= least] + (key[1].as_py() << HASH_BITS - RANGE_BITS)
        return pa.table({"length": pa.array(np.full(len(grams), key[0].as_py()), pa.int32()), "gram": pa.array(grams, pa.int64())})

    return run


def _windows(order: int, bitmaps: dict[int, bytes], bits: int):
    """Windows of ``order`` words with their counts, chunk by chunk; they end where a gram cannot be frequent."""
    names = ["lang", *(f"w{k + 1}" for k in range(order)), "c"]

    def of(run: _Run, powers: Powers, known: dict[int, np.ndarray]) -> tuple[np.ndarray, list[pa.Array], np.ndarray]:
        n, done, pad = len(run.codes), run.done, len(run.words)
        may, _ = _grams(run, powers, known, bits, max(2, min(order, max(known, default=2))))
        codes, going = run.codes, may[0][:done]
        columns = [np.where(going, codes[:done], pad)]
        for k in range(1, order):
            # The longest gram looked at that ends with this word of the window.
            size = min(k + 1, len(may))
            first = k + 1 - size
            step = np.zeros(done, bool)
            reach = max(0, min(done, n - k))
            step[:reach] = may[size - 1][first : first + reach]
            going = going & step
            column = np.full(done, pad, np.int64)
            column[going] = codes[np.flatnonzero(going) + k]
            columns.append(column)
        key = _joined([run.lang, *columns], [int(run.lang.max()) + 1, *[pad + 1] * order])
        _, where, counts = np.unique(key, return_index=True, return_counts=True)
        texts_of = pa.chunked_array([run.words, pa.array([b""], run.words.type)]).combine_chunks()
        # Words cut at the end of a chunk are in no window, so what is taken is text.
        return run.lang[where], [texts_of.take(pa.array(c[where])).cast(pa.string()) for c in columns], counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(0x5851F42D4C957F2D)
        known = {k: np.frombuffer(b, np.uint8) for k, b in dict(bitmaps).items()}
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            for part in _runs(batch.column(0), coded.indices.to_numpy().astype(np.int64), order):
                lang, columns, counts = of(part, powers, known)
                lang = coded.dictionary.take(pa.array(lang)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, *columns, pa.array(counts, pa.int64())], names)

    return run


def marginals(docs: DataFrame, order: int, bitmaps: dict[int, bytes] | None = None, bits: int = GRAM_BITS) -> DataFrame:
    """Counts of all prefixes of all windows of ``docs(text, lang)``: ``lang, w1.., f, length``.

    ``length`` is the number of words; 0 stands for the language as a whole. With bitmaps (by number of words), phrases
    that hold a gram without its bit are left out.
    """
    names = [f"w{k + 1}" for k in range(order)]
    schema = f"lang string, {', '.join(f'{n} string' for n in names)}, c bigint"
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang")).mapInArrow(_windows(order, bitmaps or {}, bits), schema)
    summed = rows.rollup("lang", *names).agg(F.sum("c").alias("f"), F.grouping_id().alias("level"))
    # A level of k rolled-up columns has the number with k bits set. Conditions on a level go below the aggregation.
    padded = reduce(lambda a, b: a | b, ((F.col("level") == (1 << (order - 1 - k)) - 1) & (F.col(n) == "") for k, n in enumerate(names)))
    summed = summed.where((F.col("level") < 1 << order) & ~F.coalesce(padded, F.lit(False)))
    return summed.withColumn("length", F.lit(order) - F.bit_count("level").cast("int")).drop("level")


def frequent_grams(docs: DataFrame, lengths: list[int], least: int, known: dict[int, bytes], bits: int = GRAM_BITS) -> tuple[dict[int, bytes], int]:
    """For each of ``lengths`` a bit for the hash of each gram of so many words that occurs ``least`` times or more (in any language).

    Grams that the bitmaps ``known`` by their length rule out are not counted; words are those of pairs that are not ruled out. All bitmaps have ``2 ** bits`` bits;
    the first ones have about 32 for each frequent gram if that is less, and the second result is this power. Grams with equal hashes are counted as one,
    which sets bits of rare grams but leaves out none of a frequent one.
    """
    packs = docs.select("text").mapInArrow(_gram_packs(lengths, known, bits, least), "length int, range int, pack binary, counts binary")
    frequent = packs.groupBy("length", "range").applyInArrow(_frequent(least), "length int, gram bigint")
    with scratch(frequent, "collocations-grams") as counted:
        if not known:
            most = max([1, *(row["count"] for row in counted.groupBy("length").count().collect())])  # a row for each length
            bits = min(bits, max(15, (32 * most).bit_length()))
        bit = F.shiftright("gram", HASH_BITS - bits) + 1
        found = counted.select("length", bit.alias("bit")).groupBy("length", F.bitmap_bucket_number("bit").alias("bucket"))
        out = {length: bytearray(max((1 << bits) // 8, 1 << 12)) for length in lengths}
        for row in found.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap")).collect():  # bounded by bits
            at = (row["bucket"] - 1) * len(row["bitmap"])
            out[row["length"]][at : at + len(row["bitmap"])] = row["bitmap"]
    return {length: bytes(bitmap) for length, bitmap in out.items()}, bits


def _wide(name: str) -> Column:
    """Products of counts may pass 64 bits."""
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, most: int = 4, least: int = 30, best: int = 2000, share: int = 80, gram_bits: int = GRAM_BITS) -> DataFrame:
    """The ``best`` phrases of 2 to ``most`` words of each language of ``docs(text, lang)``.

    A candidate occurs ``least`` times or more. Its score is the least of ``floor(2000000 * a / (l + r))`` over the cuts into two parts that
    occur ``l`` and ``r`` times (ties: the shortest first part). Candidates inside a longer candidate that has ``share`` percent of their
    occurrences or more are dropped. Returns ``lang, rank, phrase, a, l, r, n, score, cut``.
    """
    bitmaps, bits = frequent_grams(docs, [2], least, {}, gram_bits)
    for lengths in [1, 3] if most > 3 else [1], *([k] for k in range(4, most)):
        bitmaps |= frequent_grams(docs, lengths, least, bitmaps, bits)[0]
    names = [f"w{k + 1}" for k in range(most)]
    counted = marginals(docs, most, bitmaps, bits).where(f"f >= {least} OR length = 0")
    words = F.expr(f"slice(array({', '.join(names)}), 1, length)")
    counted = staged(counted.select("lang", words.alias("words"), "f").withColumn("phrase", F.array_join("words", " ")), "collocations-phrases")
    phrases = counted.where("size(words) > 0")
    candidates = phrases.where("size(words) > 1").withColumnRenamed("f", "a")

    part = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = candidates.select("lang", "phrase", "words", "a", F.expr("explode(sequence(1, size(words) - 1))").alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.expr("array_join(slice(words, 1, cut), ' ')").alias("first"), F.expr("array_join(slice(words, cut + 1, size(words)), ' ')").alias("rest"))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")).select("lang", "phrase", "a", "low.*")

    inner = "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    within = candidates.where("size(words) > 2").select("lang", F.explode(F.array_distinct(F.expr(inner))).alias("phrase"), F.col("a").alias("over"))
    within = within.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.coalesce(_wide("over") * 100 < _wide("a") * share, F.lit(True)))

    order = [F.desc("score"), F.desc("a"), "phrase"]
    # First within as many parts as a shuffle has, then among the best of all parts.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ahead = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    ahead = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= best)
    top = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= best)
    totals = counted.where("size(words) = 0").select("lang", F.col("f").alias("n"))
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def collocations_sql(least: int = 30, best: int = 2000, share: int = 80) -> str:
    """The same for DuckDB, for phrases of 2 to 4 words, with a list of windows for each length."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS size, unnest(list_transform(range(1, len(ws) - {k} + 2), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) AS phrase FROM pieces" for k in (1, 2, 3, 4)
    )
    return f"""WITH split AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
pieces AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM split),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
cuts AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, size)) AS cut FROM f WHERE size > 1),
parts AS (SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
scored AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, size, f, string_split(phrase, ' ') AS ws FROM f WHERE size > 2),
inside AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS over
  FROM (SELECT lang, f, ws, m, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM longer)) GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase) WHERE i.over IS NULL OR 100::HUGEINT * i.over < {share}::HUGEINT * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, cut::INT AS cut
FROM kept JOIN totals USING (lang) QUALIFY rank <= {best}"""
