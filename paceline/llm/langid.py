"""Language identification by nearest centroids of TF-IDF vectors of byte n-grams.

Model: every language has several centroids, found by spherical k-means over a bounded labelled sample; a text takes
the language of the centroid with the highest cosine. It is rejected where even that cosine is below a floor, which
depends on the text's length, as short texts are near nothing. Floors are set between two kinds of held-out pieces of
each length: real ones, which the centroids haven't seen, and junk: hex and base64 dumps, random letters, texts with
their characters shuffled, and texts of a language left out of the centroids. Whole texts are read, in bounded pieces.

Edge cases: a null or empty text and one without any letter give `und`, score 0 and are rejected; a null id passes
through; repeated rows give repeated results; ties go to the language that sorts first; an empty table gives no rows;
without any labelled row every prediction is `und` and nothing is rejected, as nothing is known. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_filter, arrow_map
from .textarrays import groups

_LETTER = re.compile(r"[^\W\d_]")
_TO = np.arange(256, dtype=np.uint32)
_TO[65:91] += 32
_TO[[i for i in range(128) if not chr(i).isalpha()]] = 32
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WORD = _TO != 32
_WORD[48:58] = True


@dataclass(frozen=True)
class Settings:
    """What is fitted on is bounded: `sample_per_language` rows of a language, `sample` rows and `sample_bytes` of each
    in all. More than `most_languages` languages raise ValueError."""

    dims: int = 1 << 12
    sample_per_language: int = 400
    sample: int = 8000
    sample_bytes: int = 1 << 14
    most_languages: int = 2000
    clusters: int = 3
    rounds: int = 8
    pieces: int = 400
    wrongly: float = 0.01
    piece: int = 1 << 18


#: Lengths in bytes, as powers of two, for which there is a floor.
_LENGTHS = range(3, 13)


@dataclass(frozen=True)
class Model:
    """`floors` are the least cosines at the lengths of `_LENGTHS`; `passed` and `caught` the shares of real pieces kept and of junk rejected, at each."""

    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    floors: np.ndarray
    passed: np.ndarray
    caught: np.ndarray

    def floor(self, sizes: list[int]) -> np.ndarray:
        return np.interp(np.log2(np.maximum(sizes, 1)), list(_LENGTHS), self.floors)


def _letters(raw: np.ndarray) -> np.ndarray:
    """Lower case, and blanks for what isn't a letter or stands in a word with a digit, such as keys and dumps."""
    word = _WORD[raw]
    number = np.cumsum(word & ~np.concatenate([[False], word[:-1]]))
    mixed = np.zeros(number[-1] + 1, bool)
    mixed[number[_DIGIT[raw]]] = True
    return np.where(word & ~mixed[number], _TO[raw], np.uint32(32))


def counts(texts: list[bytes], dims: int, piece: int = 1 << 18) -> np.ndarray:
    """Counts of hashed 2- and 3-byte runs, a row for each text."""
    out = np.zeros((len(texts), dims), np.float32)
    for a, b in groups([len(t) for t in texts], piece):
        step = min(b - a, 64)
        for lo in range(a, b, step):
            part = texts[lo : min(lo + step, b)]
            for at in range(0, max(map(len, part)) if len(part) == 1 else 1, piece):
                own = part if len(part) > 1 else [part[0][max(0, at - 2) : at + piece]]
                d = _letters(np.frombuffer(b"  " + b"  ".join(own) + b"  ", np.uint8))
                two = d[:-1] << 8 | d[1:]
                three = two[:-1] << 8 | d[2:]
                blanks = two == 0x2020  # runs of what isn't a letter say nothing
                edge = np.cumsum([0, *(len(t) + 2 for t in own)])
                row = np.repeat(np.arange(len(own)), np.diff(edge))
                for code, salt, void in ((two, 0x9E3779B1, blanks), (three, 0x85EBCA6B, blanks[:-1] | blanks[1:])):
                    n = min(len(row), len(code))
                    some = np.flatnonzero(~void[:n])
                    slot = (code[some] * np.uint32(salt)) >> np.uint32(32 - dims.bit_length() + 1)
                    out[lo : lo + len(own)] += np.bincount(row[some] * dims + slot, minlength=len(own) * dims).reshape(len(own), dims)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


def vectors(texts: list[bytes], idf: np.ndarray, dims: int) -> np.ndarray:
    return _unit(np.log1p(counts(texts, dims)) * idf)


def _clusters(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means from centres that are far apart."""
    centres = [_unit(x.mean(0, keepdims=True))[0]]
    while len(centres) < min(k, len(x)):
        centres.append(x[np.argmin((x @ np.array(centres).T).max(1))])
    c = np.array(centres)
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        c = _unit(np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))]))
    return c


def _junk(texts: list[bytes], size: int, rng: np.random.Generator) -> list[bytes]:
    """Pieces of about `size` bytes that are no language: dumps, random words, and texts in shuffled order."""
    out = []
    for k, t in enumerate(texts):
        raw = rng.bytes(size)
        if k % 4 == 0:
            out.append(raw.hex()[:size].encode())
        elif k % 4 == 1:
            out.append(base64.b64encode(raw)[:size])
        elif k % 4 == 2:
            letters = np.frombuffer(raw, np.uint8) % 26 + 97
            letters[rng.random(size) < 0.18] = 32
            out.append(letters.tobytes())
        else:
            own = np.frombuffer(t, np.uint8).copy()
            rng.shuffle(own)
            out.append(own.tobytes())
    return out


def _floors(texts: list[bytes], of: np.ndarray, idf: np.ndarray, c: np.ndarray, which: np.ndarray, s: Settings) -> np.ndarray:
    """Floor, share of real pieces kept and share of junk rejected, at each length, from texts that the centroids haven't seen."""
    rng, out = np.random.default_rng(7), []
    several = len(np.unique(which)) > 1
    for power in _LENGTHS:
        size, real, lang = 1 << power, [], []
        for i in rng.permutation(len(texts)):
            if len(texts[i]) >= size and len(real) < s.pieces:
                at = int(rng.integers(0, len(texts[i]) - size + 1))
                piece = texts[i][at : at + size]
                if _LETTER.search(piece.decode(errors="ignore")):
                    real.append(piece)
                    lang.append(of[i])
        if len(real) < 20:  # no text is so long: the floor of the length before
            out.append(out[-1] if out else (0.0, 1.0, 0.0))
            continue
        cos = vectors(real, idf, s.dims) @ c.T
        own = cos.max(1)
        junk = (vectors(_junk(real, size, rng), idf, s.dims) @ c.T).max(1)
        if several:
            junk = np.concatenate([junk, np.where(np.array(lang)[:, None] == which[None, :], 0, cos).max(1)])
        low, high = np.quantile(junk, 0.99), np.quantile(own, s.wrongly)
        floor = min(low, 0.85 * high)  # what junk reaches, but never near what real pieces have
        out.append((floor, (own >= floor).mean(), (junk < floor).mean()))
    return np.array(out)


def fit(docs: DataFrame, learn: Column, settings: Settings = Settings(), text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from rows where `learn` holds and text and lang are not null: a sample of each language, picked by a hash of key and text.

    Two thirds make the centroids, one third the floors.
    """
    s = settings
    held = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("h"))
    n = {r[0]: r[1] for r in held.groupBy("lang").count().limit(s.most_languages + 1).collect()}
    if len(n) > s.most_languages:
        raise ValueError(f"more than {s.most_languages} languages")
    if not n:
        none = np.zeros(len(_LENGTHS))
        return Model([], np.ones(s.dims, np.float32), np.zeros((0, s.dims)), np.zeros(0, int), none, none, none)
    most = min(s.sample_per_language, max(s.sample // len(n), 3))
    part = docs.sparkSession.createDataFrame([(k, min(1_000_000, int(1e6 * most / c) + 1)) for k, c in sorted(n.items())], "lang string, part long")
    picked = held.join(F.broadcast(part), "lang").where(F.pmod("h", F.lit(1_000_000)) < F.col("part"))
    rows = picked.select("lang", F.substring(F.encode("text", "UTF-8"), 1, s.sample_bytes).alias("text")).limit(2 * most * len(n) + 1000).collect()
    rows = sorted((r.lang, bytes(r.text)) for r in rows)
    langs = sorted({r[0] for r in rows})
    of = np.array([langs.index(r[0]) for r in rows])
    nth = np.arange(len(rows)) - np.searchsorted(of, of)
    seen = nth % 3 != 2
    raw = counts([t for (_, t), m in zip(rows, seen, strict=True) if m], s.dims)
    idf = np.log((1 + len(raw)) / (1 + (raw > 0).sum(0))).astype(np.float32) + 1
    x = _unit(np.log1p(raw) * idf)
    parts = [_clusters(x[of[seen] == k], s.clusters, s.rounds) for k in range(len(langs))]
    c, which = np.concatenate(parts).astype(np.float32), np.repeat(np.arange(len(langs)), [len(p) for p in parts])
    floors = _floors([t for (_, t), m in zip(rows, seen, strict=True) if not m], of[~seen], idf, c, which, s)
    return Model(langs, idf, c, which, *floors.T)


def predict(given: list[str | None], m: Model, settings: Settings) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and rejection of each text."""
    texts = [t if t and m.langs and _LETTER.search(t) else None for t in given]
    lang, score, gone = ["und"] * len(texts), [0.0] * len(texts), [bool(m.langs)] * len(texts)
    some = [i for i, t in enumerate(texts) if t is not None]
    if some:
        own = [texts[i].encode() for i in some]
        cos = vectors(own, m.idf, settings.dims) @ m.centroids.T
        best, floor = cos.argmax(1), m.floor([len(t) for t in own])
        for i, b, s, low in zip(some, best, cos.max(1), floor, strict=True):
            lang[i], score[i], gone[i] = m.langs[m.of[b]], float(min(max(s, 0.0), 1.0)), bool(s < low)
    return lang, score, gone


def identify(docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected, for every row."""
    at = docs.sparkSession.sparkContext.broadcast(model)  # dims x (languages x clusters) floats at most

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        lang, score, gone = predict(cols["text"], at.value, settings)
        return {"doc_id": cols["doc_id"], "lang_pred": lang, "score": score, "rejected": gone}

    return arrow_map(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id long, lang_pred string, score double, rejected boolean", of_batch, 128)


def identified(docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The rows whose text isn't rejected, with all their columns."""
    at = docs.sparkSession.sparkContext.broadcast(model)
    return arrow_filter(docs, [text], lambda cols: [not g for g in predict(cols[text], at.value, settings)[2]], 128)


def remainder(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3


def op6_language_centroids(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, remainder() != 1)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out")
    return identify(docs, model).select("doc_id", held, "lang_pred", "score", "rejected")
