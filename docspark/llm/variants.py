"""Spelling variants grouped by a search for pivotal grams.

Two words are near if one code point inserted, deleted or replaced makes one the other.  The
bigrams of all words have one order, rarest first; the prefix of a word is its three rarest
bigrams (all that are as rare as the third).  Of the prefix, dynamic programming chooses two
disjoint bigrams with the smallest sum of frequencies: the word's pivots, G1 before G2.

One edit leaves at least one pivot whole.  If the third bigram of a word comes no later in the
order than that of a near word, the whole pivot is in the near word's prefix, so a search of
pivots in prefixes, in one direction, finds every pair.  Position limits make it narrow.  An edit
to the right of G1 leaves everything up to and with G1 in place, and any other edit leaves
everything from G2 on in place, counted from the end.  What lies on the edit's side is cut in
halves by the indexed word's length; one edit leaves one half whole.  So a key is the length, the
place of the gram, the side without the edit with the gram, and one half of the other side.  A key
is shared by few words, however many words share a gram.

Defined results: null texts have no words; a null doc_id is written as nothing in the seed; a run is
counted as often as it stands, in repeated rows too; no words give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from docspark.sources import staging

MIN_CHARS = 7
MIN_COUNT = 2
# A near word is a form if it is so many times as frequent.
TIMES = 10
# A run loses a code point where this divides its seed.
EVERY = 31

# What runs consist of after A-Z have been lower-cased.
LETTERS = "a-zÀ-ÿ"


def counted(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """Words (word, n) of documents (doc_id, text); some runs lose a code point first."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Shorter runs cannot become words.
    runs = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    each = each.withColumn("seed", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("seed") % F.length("run")).cast("int")
    bent = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("seed") % every == 0, bent).otherwise(F.col("run")).alias("word")
    counts = each.select(word).where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram stands in the words: as many rows at most as pairs of letters."""
    grams = F.expr("explode(transform(sequence(1, length(word) - 1), i -> substring(word, i, 2)))")
    return dict(words.select(grams.alias("gram")).groupBy("gram").count().collect())


@dataclass
class Grams:
    counts: dict[str, int]

    def __post_init__(self) -> None:
        self.rank = {g: i for i, g in enumerate(sorted(self.counts, key=lambda g: (self.counts[g], g)))}

    def prefix(self, word: str) -> tuple[list[int], int]:
        """Where the rarest bigrams of a word stand, and the rank of the third."""
        ranks = [self.rank[word[i : i + 2]] for i in range(len(word) - 1)]
        third = sorted(ranks)[2]
        return [i for i, rank in enumerate(ranks) if rank <= third], third

    def pivots(self, word: str, places: list[int]) -> tuple[int, int]:
        """Two places of disjoint bigrams with the smallest sum of counts."""
        best_one: tuple[float, int] = (math.inf, -1)  # of the places two before this one and earlier
        best_two: tuple[float, int, int] = (math.inf, -1, -1)
        waiting: list[tuple[int, int]] = []
        for i in places:
            while waiting and waiting[0][1] <= i - 2:
                best_one = min(best_one, waiting.pop(0))
            count = self.counts[word[i : i + 2]]
            best_two = min(best_two, (best_one[0] + count, best_one[1], i))
            waiting.append((count, i))
        return best_two[1], best_two[2]


def _key(side: str, length: int, place: int, whole: str, half: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{side}{length},{place},{whole}|{half}".encode()) - 2**63


def index_keys(word: str, places: list[int]) -> Iterator[int]:
    """The keys under which a word is found by the bigrams of its prefix."""
    n = len(word)
    for p in places:
        head, rest = word[: p + 2], word[p + 2 :]
        half = len(rest) // 2
        yield _key("a", n, p, head, rest[:half])
        yield _key("b", n, p, head, rest[half:])
        tail, rest = word[p:], word[:p]
        half = p // 2
        yield _key("c", n, p, tail, rest[:half])
        yield _key("d", n, p, tail, rest[half:])


def probe_keys(word: str, first: int, second: int, min_chars: int) -> Iterator[int]:
    """The keys of all words that lie one edit away and share a pivot."""
    n = len(word)
    head, tail = word[: first + 2], word[second:]
    for length in range(max(min_chars, n - 1), n + 2):
        rest = length - first - 2  # of the other word, to the right of the first pivot
        half = rest // 2
        if rest >= 0:
            yield _key("a", length, first, head, word[first + 2 : first + 2 + half])
            if n - (rest - half) >= first + 2:
                yield _key("b", length, first, head, word[n - (rest - half) :])
        place = second + length - n
        half = place // 2
        if place >= 0:
            if half <= second:
                yield _key("c", length, place, tail, word[:half])
            if place - half <= second:
                yield _key("d", length, place, tail, word[second - (place - half) : second])


def _keyed(words: DataFrame, grams: Grams, probe: bool, min_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, thirds, texts = [], [], [], []
            for i, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                places, third = grams.prefix(word)
                if probe:
                    found = list(probe_keys(word, *grams.pivots(word, places), min_chars))
                else:
                    found = list(index_keys(word, places))
                keys += found
                ids += [i] * len(found)
                thirds += [third] * len(found)
                texts += [word] * len(found)
            columns = [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(thirds, pa.int32()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "third", "word"])

    return words.select("id", "word").mapInArrow(run, "id long, key long, third int, word string")


def near_pairs(words: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All pairs (id, other) of words (id, word) that are near, each once in either direction."""
    if min_chars < 4:
        raise ValueError("words need three bigrams")
    grams = Grams(gram_counts(words))
    probes, index = (_keyed(words, grams, probe, min_chars).alias(name) for probe, name in ((True, "p"), (False, "i")))
    earlier = F.expr("p.third < i.third OR (p.third = i.third AND p.id < i.id)")
    found = probes.join(index, (F.col("p.key") == F.col("i.key")) & earlier & (F.levenshtein("p.word", "i.word", 1) == 1))
    pairs = found.select(F.least("p.id", "i.id").alias("low"), F.greatest("p.id", "i.id").alias("high")).distinct()
    both = F.explode(F.array(F.struct(F.col("low").alias("id"), F.col("high").alias("other")), F.struct(F.col("high").alias("id"), F.col("low").alias("other"))))
    return pairs.select(both.alias("pair")).select("pair.id", "pair.other")


def _roots(forms: DataFrame, most: int, times: int) -> DataFrame:
    """Follow forms (id, to) to the last; every step is so many times as frequent as the one before."""
    steps = 1
    while steps * 1.0 < math.log(max(most, 2)) / math.log(times):
        forms, _ = staging.stage(forms, "forms")
        after = forms.select(F.col("id").alias("_id"), F.col("to").alias("_to"))
        forms = forms.join(after, F.col("to") == F.col("_id"), "left").select("id", F.coalesce("_to", "to").alias("to"))
        steps *= 2
    return forms


def grouped(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    times: int = TIMES,
    every: int = EVERY,
) -> DataFrame:
    """Every word with its form, the root that forms lead to, and the number of near words."""
    if times < 2:
        raise ValueError("a form must be more frequent than its variant")
    # Sorted, so that ids ascend as the words do.
    words = counted(docs, min_chars, min_count, every).orderBy("word").withColumn("id", F.monotonically_increasing_id())
    words, _ = staging.stage(words, "words")
    most = words.agg(F.max("n")).first()[0] or 0
    others = words.select(F.col("id").alias("other"), F.col("n").alias("other_n"))
    near = near_pairs(words, min_chars).join(others, "other").groupBy("id").agg(
        F.count("*").alias("n_near"), F.max(F.struct("other_n", (-F.col("other")).alias("back"))).alias("best")
    )
    near = near.select("id", "n_near", F.col("best.other_n").alias("form_n"), (-F.col("best.back")).alias("to"))
    judged = words.join(near, "id", "left")
    enough = F.col("form_n") >= times * F.col("n")
    judged = judged.withColumn("form_n", F.when(enough, F.col("form_n"))).withColumn("to", F.when(enough, F.col("to")))
    judged, _ = staging.stage(judged, "judged")
    roots = _roots(judged.where("to IS NOT NULL").select("id", "to"), most, times).select("id", F.col("to").alias("last"))
    names = words.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
    done = judged.join(roots, "id", "left")
    done = done.join(names.withColumnRenamed("_word", "form"), F.col("to") == F.col("_id"), "left").drop("_id")
    done = done.join(names.withColumnRenamed("_word", "root"), F.col("last") == F.col("_id"), "left").drop("_id")
    return done.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
