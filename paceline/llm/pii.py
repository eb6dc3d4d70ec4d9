"""Personal data: exact base patterns, and further spans that boosted trees choose among candidates.

Base spans (email, ip, card, phone) follow fixed patterns and always stay. High-recall generators add overlapping
candidates: loosely written addresses and numbers, and secrets. Boosted trees see format and context features of a
candidate. What they learn from is known by how it was made, not by those features: values of each kind are planted at
places of a bounded sample of the texts, with and without telling words, beside look-alikes (order numbers, dates,
ISBNs, failed checksums, commit hashes, long names); base spans of the sample, with their telling signs taken out, are
the rest. Two thirds of that are fitted; on the others each kind's threshold is set for a precision, and precision and
recall are kept in the model. The planted values are as many at any size of table, so no kind is lost on a small one.

Edge cases: null text is empty, with no spans; a null id passes through; repeated rows give repeated results;
overlapping candidates are taken by probability, then start; an empty table gives no rows, and a model that was fitted
on planted values alone. Other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, threshold
from .shared import arrow_map

KINDS = ("email", "ip", "card", "phone")
#: Kinds that have candidates.
_GENERATED = ("email", "phone", "card", "secret")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_APART = re.compile(r"[ -]")
_NOT_DIGIT = re.compile(r"[^0-9]")

_AT_WORD = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?:(?: ?(?:\.|[\[(] ?dot ?[\])]) ?| dot )[A-Za-z0-9-]{1,63}){1,4}", re.I)
_NUMBER = re.compile(r"[+(]?[0-9](?:[ ().\-]{0,2}[0-9]){6,24}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_/+=-])(?=[A-Za-z_/+=-]{0,64}[0-9])[A-Za-z0-9_/+=-]{16,256}(?![A-Za-z0-9_/+=-])")
_TELLING = re.compile(r"(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|key|credential|auth)[\w ]{0,12}[=:]\s*[\"']?$", re.I)
_OTHERWISE = re.compile(r"(?:order|invoice|isbn|serial|part|version|total|dated|commit|revision|sha|hash|digest|checksum|object|build|path|ticket|tracking)\W{0,4}(?:no\W{0,3}|id\W{0,3}|number\W{0,3})?$", re.I)
_RUN = re.compile(r"[0-9]+")
_ABOUT = re.compile(r"(?:phone|tel|call|mobile|fax|contact|mail|card|visa|ip|addr)", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of each base kind, leftmost and not overlapping; every scan is linear in the text."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out["email"].append((start, m.end()))
        # the next local part may not reach back over this sign, nor into a span
        end = m.end() if m else at + 1
        at = text.find("@", end)
    if not _DIGIT.search(text):
        return out
    for m in _DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            parts, start = m.group().split("."), m.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                stop = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out["ip"].append((start, stop))
                start = stop + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _APART.sub("", m.group())) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal; they overlap each other and the base spans."""
    out = [("email", *m.span()) for m in _AT_WORD.finditer(text)] if ("at" in text or "AT" in text) and ("[" in text or "(" in text) else []
    if _DIGIT.search(text):
        out += [("phone" if sum(c.isdigit() for c in m.group()) < 13 else "card", *m.span()) for m in _NUMBER.finditer(text)]
        out += [("secret", *m.span()) for m in _TOKEN.finditer(text)]
    return out


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    s, before = text[a:b], text[max(0, a - 32) : a]
    n, digits = b - a, [c for c in s if "0" <= c <= "9"]
    share = [s.count(c) / n for c in set(s)]
    return [
        float(([*KINDS, "secret"]).index(kind)), float(n), float(len(digits)), len(digits) / n, sum(c.isupper() for c in s) / n, sum(c in "0123456789abcdefABCDEF" for c in s) / n,
        float(sum(c in " .-()" for c in s)), float(s[0] in "+("), -sum(p * math.log2(p) for p in share), float(luhn("".join(digits))) if digits else 0.0,
        float(bool(_TELLING.search(before))), float(bool(_ABOUT.search(before))), float(a > 0 and (text[a - 1].isalnum())), float(b < len(text) and text[b].isalnum()), float(" at " in s.lower() or "at]" in s.lower() or "at)" in s.lower()),
        float(bool(_OTHERWISE.search(before))), float(len(runs := _RUN.findall(s))), float(max(map(len, runs), default=0)), float(s.count("_") + s.count("/")), float(s[0] in "(0"),
    ]


#: What stands before planted values, of each kind and of its look-alikes.
_LEADS = {
    ("email", True): ("mail ", "write to ", "contact: ", "", ""),
    ("email", False): ("we met ", "look ", "", "", "aimed "),
    ("phone", True): ("call ", "tel. ", "phone: ", "mobile ", "fax ", "reach me on ", "", ""),
    ("phone", False): ("order ", "invoice no. ", "serial ", "part ", "dated ", "total ", "version ", "", ""),
    ("card", True): ("card ", "visa ", "pay with ", "", ""),
    ("card", False): ("tracking ", "isbn ", "ticket no. ", "order ", "", ""),
    ("secret", True): ('token = "', "api_key: ", "password=", "secret: ", 'access key = "', "auth: ", "SECRET_KEY="),
    ("secret", False): ("commit ", "revision ", "sha ", "object id ", "checksum ", "path ", "", "", "build "),
}


def _value(kind: str, real: bool, rng: random.Random) -> str:
    """A planted value of a kind, or what looks like one."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    if kind == "email":
        at = rng.choice((" [at] ", "[at]", " (at) ", "(at)"))
        if real:
            dot = rng.choice((".", " dot ", " [dot] ", "(dot)"))
            return word(rng.randint(3, 9)) + rng.choice(("", "." + word(4), d(2))) + at + word(rng.randint(4, 9)) + dot + rng.choice(("com", "org", "net", "example" + dot + "org", "de", "co" + dot + "uk"))
        return rng.choice((f"{word(5)}{at}{rng.randint(1, 12)}.{d(2)}", f"{word(6)}{at}{word(6)}. {word(5).title()}", f"{word(4)}{at}{d(1)}.{d(1)}"))
    if kind == "phone":
        if real:
            return rng.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(3)} {d(3)} {d(4)}", f"00{d(2)} {d(3)} {d(3)} {d(2)}", f"(0{d(2)}) {d(4)} {d(4)}"))
        return rng.choice((d(rng.randint(8, 12)), f"20{d(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", f"20{d(2)}-1{rng.randint(0, 2)}-{rng.randint(10, 28)} {rng.randint(10, 23)}.{d(2)}", f"{d(2)} {d(2)} {d(2)} {d(2)}", f"{d(2)}.{d(4)} {d(1)}.{d(4)}", f"{d(4)}-{d(4)}", f"{d(1)}.{d(2)}.{d(5)}"))
    if kind == "card":
        n = rng.choice((15, 16, 16, 16))
        body = rng.choice("3456") + d(n - 2)
        last = next(c for c in "0123456789" if luhn(body + c))
        digits = body + (last if real else rng.choice([c for c in "0123456789" if c != last]))
        sep = rng.choice((".", " - ", "  ")) if real else rng.choice(("", " ", "-", "."))
        if not real and rng.random() < 0.4:
            return rng.choice((f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(14)}", f"{d(6)} {d(6)} {d(6)}"))
        return sep.join(digits[i : i + 4] for i in range(0, n, 4))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n - 2)) + d(2)
    mixed = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n - 2)) + d(2)
    if real:
        return rng.choice((hexes(rng.choice((32, 40, 64))), mixed(rng.randint(20, 48)), f"{word(2)}_{word(4)}_{mixed(24)}", word(3).upper() + mixed(17).upper()))
    return rng.choice((hexes(rng.choice((32, 40, 64))), hexes(40), f"{word(5)}_{word(6)}_{word(4)}_{d(4)}", f"/{word(4)}/{word(7)}/{word(6)}/{d(3)}", f"{hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(12)}", f"{word(9)}{d(1)}{word(8)}"))


def _bare(kind: str, value: str, rng: random.Random) -> str | None:
    """A base span without its telling sign: what the base patterns no longer find."""
    if kind == "email":
        return value.replace("@", rng.choice((" [at] ", "(at)")), 1)
    if kind == "phone":
        return value[1:].lstrip() if sum(c.isdigit() for c in value) < 13 else None
    if kind == "card":
        digits = _NOT_DIGIT.sub("", value)
        return ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return None


@dataclass
class Model:
    """Trees, the threshold of each kind, and its precision and recall on what was held out. An empty one selects nothing."""

    trees: Boosted | None = None
    cut: dict[str, float] = field(default_factory=dict)
    quality: dict[str, tuple[float, float]] = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    """`sample` rows, `sample_chars` of each and `sample_spans` base spans of a kind in a row bound what is drawn; `planted` values of each kind, and as many look-alikes, are planted."""

    sample: int = 1000
    sample_chars: int = 1 << 14
    sample_spans: int = 4
    planted: int = 300
    precision: float = 0.98
    seed: int = 5


def examples(texts: list[str], s: Settings) -> list[tuple[str, list[float], bool]]:
    """(kind, features, personal) of candidates whose origin is known."""
    rng, out = random.Random(s.seed), []

    def add(before: str, value: str, after: str, kind: str, real: bool) -> None:
        text, a = before + value + after, len(before)
        b = a + len(value)
        for k, i, j in candidates(text):
            if i < b and j > a and k == kind:  # of a real value, what covers it
                out.append((kind, features(text, k, i, j), real and i <= a and j >= b))

    for kind in (*_GENERATED,):
        for n in range(2 * s.planted):
            real, t = n % 2 == 0, rng.choice(texts) if texts else ""
            at = t.find(" ", rng.randint(0, len(t))) if t else 0
            lead = rng.choice(_LEADS[kind, real])
            value = _value(kind, real, rng)
            add(f"{t[max(0, at - 80) : max(at, 0)]} {lead}", value, ('"' if lead.endswith('"') else "") + t[max(at, 0) : at + 80], kind, real)
    for t in texts:
        for kind, spans in base_spans(t).items():
            for a, b in spans[: s.sample_spans]:
                bare = _bare(kind, t[a:b], rng)
                if bare:
                    add(t[max(0, a - 80) : a], bare, t[b : b + 80], kind, True)
    return out


def fit(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> Model:
    """Fit on values planted into at most `sample` rows, picked by a hash of key and text, and on those rows' base spans."""
    own = docs.select(F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("h"), F.substring(F.col(text), 1, settings.sample_chars).alias("text")).where(F.col("text").rlike("[0-9@]"))
    n = own.count()
    share = min(1_000_000, int(0.8e6 * settings.sample / max(n, 1)) + 1)
    rows = sorted((r.h, r.text) for r in own.where(F.pmod("h", F.lit(1_000_000)) < share).limit(settings.sample).collect())
    found = examples([t for _, t in rows], settings)
    kinds, x, y = np.array([f[0] for f in found]), np.array([f[1] for f in found]), np.array([f[2] for f in found], float)
    held = np.random.default_rng(settings.seed).random(len(y)) < 1 / 3
    trees = Boosted().fit(x[~held], y[~held])
    p, model = trees.predict(x), Model(trees)
    for k in _GENERATED:
        own_p, own_y = p[held & (kinds == k)], y[held & (kinds == k)]
        cut = model.cut[k] = max(0.5, threshold(own_p, own_y, settings.precision))
        hit = own_p >= cut
        model.quality[k] = (float(own_y[hit].mean()) if hit.any() else 1.0, float(hit[own_y > 0].mean()) if own_y.any() else 0.0)
    return model


def select(text: str, base: dict[str, list[tuple[int, int]]], model: Model) -> list[tuple[str, int, int]]:
    """The spans added to the base ones: likely candidates that overlap neither a base span nor a likelier candidate."""
    found = candidates(text) if model.trees else []
    if not found:
        return []
    taken = sorted(s for v in base.values() for s in v)
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else []
    found = [c for c in found if not ((i := bisect_right(taken, (c[2] - 1, math.inf))) and reach[i - 1] > c[1])]
    if not found:
        return []
    p = model.trees.predict(np.array([features(text, *c) for c in found]))
    out: list[tuple[int, int, str]] = []
    for q, (k, a, b) in sorted(zip(-p, found, strict=True), key=lambda z: (z[0], z[1][1], -z[1][2])):
        i = bisect_right(out, (a, b, ""))
        if -q >= model.cut[k] and (i == 0 or out[i - 1][1] <= a) and (i == len(out) or out[i][0] >= b):
            out.insert(i, (a, b, k))
    return [(k, a, b) for a, b, k in out]


def find(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text with every span replaced by its kind, and the base and added spans as kind:start:end."""
    at = docs.sparkSession.sparkContext.broadcast(model)  # some forty trees of eight leaves

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": cols["doc_id"], "redacted": [], "base": [], "added": [], **{f"n_{k}": [] for k in KINDS}}
        for t in cols["text"]:
            t = t or ""
            base = base_spans(t)
            more = select(t, base, at.value)
            own = [(k, a, b) for k in KINDS for a, b in base[k]]
            out["base"].append(",".join(f"{k}:{a}:{b}" for k, a, b in own))
            out["added"].append(",".join(f"{k}:{a}:{b}" for k, a, b in more))
            for k in KINDS:
                out[f"n_{k}"].append(len(base[k]))
            parts, end = [], 0
            for a, b, k in sorted((a, b, k) for k, a, b in own + more):
                if b > end:
                    parts += [t[end:a], f"<{k}>" if a >= end else ""]
                    end = b
            out["redacted"].append("".join([*parts, t[end:]]))
        return out

    return arrow_map(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id long, redacted string, base string, added string, n_email long, n_ip long, n_card long, n_phone long", of_batch, 256)


def op5_personal_data(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find(docs, fit(docs))
    n_added = F.size(F.filter(F.split("added", ","), lambda x: x != "")).cast("long")
    return found.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        joined(F.col("base"), F.col("added")).alias("spans"), n_added.alias("n_added"),
        (reduce(add, [F.col(f"n_{k}") for k in KINDS]) + n_added).alias("n_spans"), F.sha2(F.col("redacted").cast("binary"), 256).alias("redacted_sha256"),
    )


def joined(base, added):
    """All spans, those of a kind together: the base kinds as listed, then others, each by start."""
    split = F.filter(F.concat(F.split(base, ","), F.split(added, ",")), lambda s: s != "")
    order = F.array(*[F.lit(k) for k in (*KINDS, "secret")])
    keyed = F.transform(split, lambda s: F.struct(F.array_position(order, F.split_part(s, F.lit(":"), F.lit(1))).alias("k"), F.split_part(s, F.lit(":"), F.lit(2)).cast("long").alias("a"), s.alias("s")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["s"]), ",")
