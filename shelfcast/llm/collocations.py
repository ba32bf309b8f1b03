"""Collocations: frequent phrases by language, counted by an FM-index per shard and summed over the shards.

A shard is a run of pieces with about ``SHARD_WORDS`` words, its words numbered by language. Three rounds read the
texts. The first two sum up hashes of words and of pairs of neighbours; the hashes that are frequent over all shards
become a bitmap of bounded size, and in the next round other words and pairs end a phrase, so that an index holds
little that cannot be in a result. The last round sums up the phrases themselves. A hash that collides lets a rare
phrase into that sum and never keeps a frequent one out, so the counts are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, giving_back, spark_schema, written
from shelfcast.llm.fm_index import FmIndex

#: Words of a shard, bytes of text that are split at a time, rows handed on at a time.
SHARD_WORDS, SLICE_BYTES, OUT_ROWS = 1 << 20, 1 << 20, 1 << 16
#: Bits of a bitmap per frequent hash, and the least and most bits, as powers of two: 128 MB at most are sent to the tasks.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 23, 30
#: Candidates that are ranked together before those of a language are.
RANK_ROWS = 100_000
UNKNOWN = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(BREAKS + b"\t" + bytes(range(65, 91)), b"\n" * len(BREAKS) + b" " + bytes(range(97, 123)))
NUMBER = T.DecimalType(38, 0)


def text_slices(data: bytes, limit: int) -> Iterator[bytes]:
    """Folded text in slices of about ``limit`` bytes that end at a blank or a break; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = at + limit
        if end < len(data):
            cut = max(data.rfind(b" ", at, end), data.rfind(b"\n", at, end))
            if cut < 0:
                later = [p for p in (data.find(b" ", end), data.find(b"\n", end)) if p >= 0]
                cut = min(later, default=len(data) - 1)
            end = cut + 1
        yield data[at:end]
        at = end


class Numbers(dict):
    """The numbers of the words of one language; 0 is a break, -1 nothing, a new word takes the next number."""

    def __init__(self, lang: str, words: list):
        super().__init__({b"\n": 0, b"": -1})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append((self.lang, word))
        return number


class Shard:
    """Words read so far. ``context`` words at its beginning belong to the shard before and only give new ones a left side."""

    def __init__(self):
        self.words: list = [("", b"")]
        self.langs: dict[str, Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = self.context = 0

    def add(self, lang: str, piece: bytes) -> None:
        numbers = self.langs.get(lang)
        if numbers is None:
            numbers = self.langs[lang] = Numbers(lang, self.words)
        ids = np.array(list(map(numbers.__getitem__, piece.replace(b"\n", b" \n ").split(b" "))), dtype=np.int32)
        self.parts.append(ids[ids >= 0])
        self.size += len(self.parts[-1])

    def end(self) -> None:
        self.parts.append(np.zeros(1, dtype=np.int32))

    def text(self) -> np.ndarray:
        return np.concatenate([*self.parts, np.zeros(1, dtype=np.int32)])

    def open_words(self, most: int) -> list[bytes]:
        """The last words of a piece that goes on, ``most`` at most."""
        last = self.text()[:-1][-most:]
        breaks = np.flatnonzero(last == 0)
        return [self.words[i][1] for i in last[breaks[-1] + 1 if len(breaks) else 0 :].tolist()]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word and its language."""
        import xxhash

        seed = {lang: xxhash.xxh64_intdigest(lang.encode()) for lang in self.langs}
        return np.array([xxhash.xxh64_intdigest(w, seed=seed.get(lang, 0)) for lang, w in self.words], dtype=np.uint64)


def over_shards(docs: DataFrame, fields: list, work: Callable[[Shard], Iterator[tuple]], longest: int) -> DataFrame:
    """The columns that ``work`` makes of each shard of (lang, text). A task cuts its own documents; a long one spans shards."""
    most_words, most_bytes = SHARD_WORDS, SLICE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, shard = arrow_schema(fields), Shard()

        def rows() -> Iterator[pa.RecordBatch]:
            for columns in work(shard):
                for at in range(0, len(columns[0]), OUT_ROWS):
                    yield batch_of(schema, *[c[at : at + OUT_ROWS] for c in columns])

        for batch in batches:
            for langs, texts in byte_chunks(batch):
                for lang, text in zip(langs.to_pylist(), texts, strict=True):
                    for piece in text_slices((text or b"").translate(_FOLD), most_bytes):
                        if shard.size >= most_words:
                            yield from rows()
                            open_words = shard.open_words(longest - 1)
                            shard = Shard()
                            if open_words:
                                shard.add(lang, b" ".join(open_words))
                            shard.context = len(open_words)
                        shard.add(lang, piece)
                    shard.end()
        if shard.size:
            yield from rows()

    return docs.mapInArrow(giving_back(run), spark_schema(fields))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    out = left * np.uint64(0x9E3779B97F4A7C15) + right
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


class Bitmap:
    """A set of hashes by their topmost ``power`` bits; may hold more than was put in, never less."""

    def __init__(self, power: int, bits: np.ndarray):
        self.power, self.bits = power, bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes >> np.uint64(64 - self.power)).astype(np.int64)
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def frequent_bitmap(counted: DataFrame, least: int) -> tuple[int, bytes]:
    """The bitmap of the hashes of (hash, n) that sum up to ``least``; at most 2 ** ``MOST_BITS`` bits reach the driver."""
    often = written(counted.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("hash"), "often")
    power = min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * often.count()).bit_length()))
    place = F.shiftrightunsigned("hash", 64 - power)
    size = 1 << 15  # bits of one bitmap that Spark builds
    parts = often.groupBy(F.floor(place / size).alias("bucket")).agg(F.bitmap_construct_agg(place % size).alias("bits"))
    bits = bytearray((1 << power) >> 3)
    for r in parts.toLocalIterator():
        bits[r["bucket"] * size >> 3 : (r["bucket"] + 1) * size >> 3] = r["bits"]
    return power, bytes(bits)


def _dense(values: np.ndarray, size: int) -> np.ndarray:
    """A table from the numbers below ``size`` to 1, 2, .. for those in ``values``, 0 for others."""
    out = np.zeros(size, dtype=np.int64)
    out[values] = np.arange(1, len(values) + 1)
    return out


def frequent_words(shard: Shard, words: Bitmap) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """The shard's text with only frequent words, their hashes, the context left, and their numbers in the shard."""
    hashes, text = shard.hashes(), shard.text()
    known = words.has(hashes)
    known[0] = False
    local = np.flatnonzero(known)
    text = _dense(local, len(hashes))[text]
    keep = text > 0
    keep[1:] |= keep[:-1]  # one break behind each run
    return text[keep], np.concatenate([[np.uint64(0)], hashes[local]]), int(keep[: shard.context].sum()), local


HASHED = [("hash", T.LongType()), ("n", T.LongType())]
SPELLED = [("lang", T.StringType()), ("phrase", T.StringType()), ("n", T.LongType())]


def count_words(shard: Shard) -> Iterator[tuple]:
    """Hashes of the words with their counts."""
    counts = np.bincount(shard.text()[shard.context :], minlength=len(shard.words))
    yield shard.hashes()[1:].view(np.int64), counts[1:]


def count_pairs(shard: Shard, words: Bitmap) -> Iterator[tuple]:
    """Hashes of the pairs of neighbouring frequent words with their counts."""
    text, hashes, context, local = frequent_words(shard, words)
    *_, (pairs, count) = FmIndex(text, len(local) + 1, 2).phrases(context)
    yield mixed(hashes[pairs[:, 0]], hashes[pairs[:, 1]]).view(np.int64), count


def count_phrases(shard: Shard, words: Bitmap, pairs: Bitmap, longest: int) -> Iterator[tuple]:
    """The phrases of up to ``longest`` words whose words and pairs are frequent, with their counts; the empty one counts all words."""
    langs = pa.array([lang for lang, _ in shard.words], type=pa.string())
    spelled = pa.array([w for _, w in shard.words], type=pa.binary()).cast(pa.string())
    counts = np.bincount(shard.text()[shard.context :], minlength=len(shard.words))
    counts[0] = 0
    for lang, numbers in shard.langs.items():
        own = np.array([i for i in numbers.values() if i > 0], dtype=np.int64)
        yield [lang], [""], [int(counts[own].sum())]
    text, hashes, context, local = frequent_words(shard, words)
    own = local[counts[local] > 0]
    yield langs.take(pa.array(own)), spelled.take(pa.array(own)), counts[own]
    linked = np.zeros(len(text) + 1, dtype=bool)  # position i - 1 with its right neighbour
    linked[1:-1] = (text[:-1] > 0) & (text[1:] > 0) & pairs.has(mixed(hashes[text[:-1]], hashes[text[1:]]))
    here = linked[1:] | linked[:-1]  # in a run of two words or more
    runs = np.stack([text, np.where(linked[1:], -1, 0)], axis=1)
    keep = here[:, None] & (runs >= 0)
    for found, count in FmIndex(runs[keep], len(local) + 1, longest).phrases(int(keep[:context].sum())):
        real = np.flatnonzero(count)
        if found.shape[1] > 1 and len(real):
            number = local[found[real] - 1]
            parts = [spelled.take(pa.array(c)) for c in number.T]
            yield langs.take(pa.array(number[:, 0])), pc.binary_join_element_wise(*parts, " "), count[real]


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact up to 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, n, left, right)]
    top = (F.lit(1000).cast("decimal(4,0)") * wide[0]).cast(NUMBER) * wide[1]
    return F.call_function("div", top.cast(NUMBER), (wide[2] * wide[3]).cast(NUMBER))


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of every phrase of up to ``longest`` words that occurs ``least`` times, and (lang, n) of all words."""
    context = docs.sparkSession.sparkContext
    words = context.broadcast(frequent_bitmap(over_shards(docs, HASHED, count_words, longest), least))

    def bitmap(sent) -> Bitmap:
        power, bits = sent.value
        return Bitmap(power, np.frombuffer(bits, dtype=np.uint8))

    pairs = context.broadcast(frequent_bitmap(over_shards(docs, HASHED, lambda shard: count_pairs(shard, bitmap(words)), longest), least))
    counted = over_shards(docs, SPELLED, lambda shard: count_phrases(shard, bitmap(words), bitmap(pairs), longest), longest)
    often = written(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == "")), "phrases")
    phrases = often.where("phrase != ''").select("lang", "phrase", F.split("phrase", " ").alias("words"), "f")
    return phrases, often.where("phrase = ''").select("lang", F.col("f").alias("n"))


def mine_collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language that hold together best.

    A phrase of 2 to ``longest`` words (3 at least) within a piece of text, found ``a`` >= ``least`` times, is scored at each cut by
    floor(1000 * a * n / (l * r)), l and r being the counts of its two parts and n that of all words of the language;
    the lowest score counts, the first cut of a tie. One that lies in a longer one just as frequent is left out. By score and
    count descending, then by phrase. Null languages are ``und``; null and empty texts have no words; repeated rows
    count as often as they occur; an empty table gives no rows. Texts of any length are read in slices.
    """
    docs = df.select(F.coalesce(df[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"), df[text_col].cast("string").alias("text"))
    phrases, totals = frequent_phrases(docs, least, max(longest, 3))
    long_ones = phrases.where(F.size("words") >= 2)
    size = F.size("words")
    cut = long_ones.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    halves = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("tail"),
    )
    left = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = halves.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).join(totals, "lang")
    lowest = F.min(F.struct(_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut")
    whole = scored.groupBy("lang", "phrase", "a", "n").agg(lowest)
    longer = long_ones.where(size >= 3)
    ends = [longer.select("lang", F.array_join(F.slice("words", start, size - 1), " ").alias("phrase"), F.col("f").alias("a")) for start in (F.lit(1), F.lit(2))]
    kept = whole.join(ends[0].unionByName(ends[1]).distinct(), ["lang", "phrase", "a"], "left_anti")
    found = written(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    groups = F.pmod(F.xxhash64("phrase"), F.lit(max(1, found.count() // RANK_ROWS)))
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("lang", groups).orderBy(*order))).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
