"""Benchmark decontamination by greedy string tiling, so that reordered passages are caught too.

Words are runs of letters and digits of any script, in lower case and compatibility form; of scripts without blanks each
character is a word. Runs of `least` words of the benchmark (of a shorter item, all its words) are seeds. Texts that
hold seeds are joined to items by them; where seeds meet, and only there, can tiles lie, so each pair is tiled there:
running Karp-Rabin looks for the longest matches of unmarked words, marks them from the longest on, never overlapping,
and goes on with shorter ones down to `least` words. An item whose words are covered to `coverage` or more is in the text.

Seeds, texts and items are tables, whatever the benchmark's size. One bitmap of seeds is broadcast, of 2^26 bits at
most, so that texts without any send nothing. An item of n words can only be covered if a certain number of its seeds
are in the text, so its most frequent ones, one fewer than that, needn't be joined: a run of words that many texts and
items hold pairs nothing by itself. Equal texts and equal items are paired and tiled once.

Edge cases: null and empty texts hold nothing, and null items or ones without a word are in nothing; an item with fewer
words than `least` is found where it stands whole; a null id of a text or item passes through; repeated rows and equal
items give repeated results; an empty table on either side gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_map, written
from .textarrays import U, groups, mix, shingles, word_hashes

_BLANK = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))
_BETWEEN = re.compile(r"[\W_]+")
#: Scripts that don't set blanks between words: Thai and Lao, Myanmar, Khmer, kana, Han.
_ALONE = re.compile(r"([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


@dataclass(frozen=True)
class Settings:
    """`most_bits` bounds the broadcast bitmap: 2^26 bits are 8 MB."""

    least: int = 5
    coverage: float = 0.6
    most_bits: int = 26


def normal(text: str | None) -> bytes:
    """Words in lower case with blanks between."""
    if not text:
        return b""
    if text.isascii():
        return text.lower().encode().translate(_BLANK)
    return _ALONE.sub(r" \1 ", _BETWEEN.sub(" ", unicodedata.normalize("NFKC", text).lower())).encode()


def needed(words: int, s: Settings) -> tuple[int, int]:
    """Of an item of so many words: the words that must be covered, and the places of seeds that must be in a text then.

    Tiles of L words hold L - k + 1 seeds of k words, so n covered words hold at least n / k.
    """
    n = math.ceil(s.coverage * words - 1e-9)
    return n, max(-(-n // min(s.least, words)), 1)


def tiles(text: list[int], item: list[int], least: int) -> list[tuple[int, int, int]]:
    """(place in text, place in item, words) of greedy string tiling; negative words match nothing."""
    used_t, used_i = [w < 0 for w in text], [False] * len(item)
    out: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(text), 20))

    def rolling(words: list[int], used: list[bool], n: int):
        """Places of n unmarked words and their rolling hash."""
        h = run = 0
        top = pow(1_000_003, n, (1 << 61) - 1)
        for k, w in enumerate(words):
            if used[k]:
                h = run = 0
                continue
            h, run = (h * 1_000_003 + w + 1) % ((1 << 61) - 1), run + 1
            if run > n:
                h = (h - (words[k - n] + 1) * top) % ((1 << 61) - 1)
            if run >= n:
                yield k - n + 1, h

    while True:
        places = defaultdict(list)
        for k, h in rolling(item, used_i, size):
            places[h].append(k)
        found, longest = [], 0
        for a, h in rolling(text, used_t, size) if places else ():
            for b in places.get(h, ()):
                if a and b and not used_t[a - 1] and not used_i[b - 1] and text[a - 1] == item[b - 1]:
                    continue  # a part of the match one word before
                n = 0
                while a + n < len(text) and b + n < len(item) and not used_t[a + n] and not used_i[b + n] and text[a + n] == item[b + n]:
                    n += 1
                if n >= size:
                    found.append((n, a, b))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        # longest first; what a longer tile has cut is looked at again, if enough is left
        found.sort(key=lambda m: (-m[0], m[1], m[2]))
        again = False
        for n, a, b in found:
            if any(used_t[a : a + n]) or any(used_i[b : b + n]):
                again = True
                continue
            out.append((a, b, n))
            used_t[a : a + n] = used_i[b : b + n] = [True] * n
        if again:
            continue
        if size == least:
            return out
        size = max(size // 2, least)


class Bitmap:
    """Which seeds the benchmark may have; a few others pass, none is missed."""

    def __init__(self, slots: np.ndarray, values: np.ndarray, bits: int):
        self.shift = U(64 - bits)
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[slots] = values.view(np.uint64)

    def has(self, seeds: np.ndarray) -> np.ndarray:
        slot = seeds >> self.shift
        return (self.words[(slot >> U(6)).astype(np.int64)] >> (slot & U(63)) & U(1)).astype(bool)


def hits(texts: list[str | None], bitmap: Bitmap, lengths: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(text, distinct seeds, words that seeds cover) of the texts that hold any; -1 stands between stretches."""
    own, out = [normal(t) for t in texts], []
    for a, z in groups([len(t) for t in own]):
        h, of = word_hashes(own[a:z])
        edge, found, where = np.zeros(len(h) + 1, np.int32), [], []
        for k in lengths:
            s = shingles(h, k)
            at = np.flatnonzero(bitmap.has(s) & (of[: len(s)] == of[k - 1 : k - 1 + len(s)]))
            edge[at] += 1
            edge[at + k] -= 1
            found.append(s[at])
            where.append(of[at])
        at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(at):
            continue
        seed, of_seed, doc = np.concatenate(found).view(np.int64), np.concatenate(where), of[at]
        words = (h[at] >> U(2)).astype(np.int64)
        gap = np.flatnonzero((np.diff(at) != 1) & (np.diff(doc) == 0)) + 1
        words, doc = np.insert(words, gap, -1), np.insert(doc, gap, doc[gap])
        for d in np.unique(doc).tolist():
            out.append((a + d, np.unique(seed[of_seed == d]), words[slice(*np.searchsorted(doc, [d, d + 1]))]))
    return out


def tabled(benchmark: DataFrame, s: Settings, item: str, item_text: str) -> DataFrame:
    """item_id, a and b (which tell equal items), words, and the seed at each place."""

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("item_id", "a", "b", "words", "seeds")}
        for name, text in zip(cols["item_id"], cols["text"], strict=True):
            h, _ = word_hashes([normal(text)])
            if len(h):
                k = np.arange(1, len(h) + 1, dtype=np.uint64)
                with np.errstate(over="ignore"):
                    keys = [(mix(mix(h + salt) + k).sum(dtype=np.uint64) + U(len(h))).view(np.int64) for salt in (U(1), U(2))]
                for n, v in zip(out, (name, int(keys[0]), int(keys[1]), (h >> U(2)).astype(np.int64), shingles(h, min(s.least, len(h))).view(np.int64)), strict=True):
                    out[n].append(v)
        return out

    own = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    return written(arrow_map(own, "item_id long, a long, b long, words array<long>, seeds array<long>", of_batch), "items")


def bitmap_of(items: DataFrame, s: Settings) -> tuple[Bitmap, list[int]] | None:
    """The bitmap of all seeds, and their lengths in words; nothing without items."""
    n = items.agg(F.sum(F.size("seeds")), F.collect_set(F.least(F.size("words"), F.lit(s.least)))).first()
    if not n[0]:
        return None
    bits = min(max(n[0].bit_length() + 7, 12), s.most_bits)
    slot = F.shiftrightunsigned("seed", 64 - bits)
    # a row for each 64 bits: 2^20 at most
    rows = items.select(F.explode("seeds").alias("seed")).groupBy(F.shiftright(slot, 6).alias("slot")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(seed, {64 - bits}) & 63 as int)))").alias("value")).toArrow()
    return Bitmap(rows.column("slot").to_numpy(), rows.column("value").to_numpy(), bits), sorted(n[1])


def matched(docs: DataFrame, items: DataFrame, s: Settings, key: str, text: str) -> tuple[DataFrame, DataFrame] | None:
    """Rows with hits (doc_id, t, u), and pairs of text (t, u) and item (a, b) with their tiles; nothing without items."""
    known = bitmap_of(items, s)
    if known is None:
        return None
    at = docs.sparkSession.sparkContext.broadcast(known)  # 8 MB at most

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        rows = [(cols["doc_id"][d], cols["t"][d], cols["u"][d], seeds, words) for d, seeds, words in hits(cols["text"], *at.value)]
        return {n: [r[k] for r in rows] for k, n in enumerate(("doc_id", "t", "u", "seeds", "words"))}

    own = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), *_digest(F.col(text), "t", "u"), F.col(text).alias("text"))
    hit = written(arrow_map(own, "doc_id long, t long, u long, seeds array<long>, words array<long>", of_batch, 512), "hits")
    texts = written(hit.select("t", "u", "seeds", "words").dropDuplicates(["t", "u"]), "texts")
    classes = items.dropDuplicates(["a", "b"]).select("a", "b", "words", "seeds")
    # of each item its rarest seeds: all but as many as must be met, and one more
    held = texts.select("t", "u", F.explode("seeds").alias("seed"))
    often = held.groupBy("seed").agg(F.count("*").alias("often"))
    places = classes.select("a", "b", F.size("words").alias("n"), F.posexplode("seeds").alias("place", "seed")).join(often, "seed", "left")
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.coalesce("often", F.lit(0)), "seed", "place"))
    n = F.ceil(F.lit(s.coverage) * F.col("n") - 1e-9)
    least = F.greatest(F.ceil(n / F.least(F.lit(s.least), "n")), F.lit(1))
    all_places = F.col("n") - F.least(F.lit(s.least), "n") + 1
    rare = places.withColumn("rank", rank).where((F.col("rank") <= all_places - least + 1) & F.col("often").isNotNull()).select("seed", "a", "b").distinct()
    pairs = written(held.join(rare, "seed").select("t", "u", "a", "b").distinct(), "pairs")
    met = pairs.join(texts.withColumnsRenamed({"words": "text_words", "seeds": "text_seeds"}), ["t", "u"]).join(classes, ["a", "b"])

    def tile(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("t", "u", "a", "b", "n_tiles", "n_covered", "n_words")}
        for t, u, a, b, text_words, text_seeds, words, seeds in zip(*(cols[n] for n in ("t", "u", "a", "b", "text_words", "text_seeds", "words", "seeds")), strict=True):
            k, (least_words, least_places) = min(s.least, len(words)), needed(len(words), s)
            inside = np.flatnonzero(np.isin(seeds, text_seeds))
            reach = np.zeros(len(words) + 1, np.int64)
            reach[inside] += 1
            reach[inside + k] -= 1
            if len(inside) < least_places or (np.cumsum(reach) > 0).sum() < least_words:
                continue
            got = tiles(text_words, words, k)
            covered = sum(m for _, _, m in got)
            if covered >= least_words:
                for n, v in zip(out, (t, u, a, b, len(got), covered, len(words)), strict=True):
                    out[n].append(v)
        return out

    return hit.select("doc_id", "t", "u"), arrow_map(met, "t long, u long, a long, b long, n_tiles int, n_covered int, n_words int", tile, 512)


def _digest(text, *names: str) -> list:
    """128 bits of a text."""
    return [F.xxhash64(F.lit(k), text).alias(n) for k, n in enumerate(names)]


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_tiles, n_covered, n_words and coverage of each text and item that it holds."""
    items = tabled(benchmark, settings, item, item_text)
    found = matched(docs, items, settings, key, text)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_tiles int, n_covered int, n_words int, coverage double")
    rows, pairs = found[0], written(found[1], "tiles")
    out = rows.join(pairs, ["t", "u"]).join(items.select("item_id", "a", "b"), ["a", "b"])
    return out.select("doc_id", "item_id", "n_tiles", "n_covered", "n_words", (F.col("n_covered") / F.col("n_words")).alias("coverage"))


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows that hold no item, with all their columns."""
    found = matched(docs.select(F.lit(0).alias("doc_id"), F.col(text).alias("text")), tabled(benchmark, settings, item, item_text), settings, "doc_id", "text")
    if found is None:
        return docs
    names = [f"_{uuid.uuid4().hex}" for _ in range(2)]
    gone = written(found[1].select("t", "u").distinct(), "contaminated").toDF(*names)
    same = [d == F.col(n) for d, n in zip(_digest(docs[text], *names), names, strict=True)]
    return docs.join(gone, same[0] & same[1], "left_anti")


def op1_string_tiling(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
