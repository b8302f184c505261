"""Problem 6: records that hold template residue or an error page instead of content.

A regularised logistic regression on hashed word 1- and 2-grams of what is left of a
page after its menus, notices and footers, on its length, and on its title. It is
trained on weak labels: phrases of error pages and templates, response statuses of
the page's fetches, and signs of a real profile. The training rows are a bounded
sample (``MAX_TRAIN``) by hash of the id; every record is scored with its whole text.

Defined cases: null, empty and blank texts hold no content and are cases; a repeated
row is one case; a null title counts as an empty one; with no weak label of a case in
the sample the seed phrases still give cases to learn from; with none of content
nothing is fitted and the weak labels stand; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import templates
from lectern.llm.layout import _YEARS, alike, elements, has_position, name_words
from lectern.llm.quality import COMMON
from lectern.session import spread

BITS = 16
MAX_TRAIN = 6000
L2, STEPS, RATE = 1e-4, 250, 0.1
CUT = 0.5

# What error pages, waiting pages and templates say.
SEEDS = """404 not found the page you are looking for could not be located
sorry there is nothing at this address
access denied you do not have permission to open this page
403 forbidden
410 gone the resource is no longer here and there is no forwarding address
sign in to continue your session has expired enter your account to view
please log in to view this page
please turn on javascript and reload this page this application will not work without scripts
enable javascript to run this app
bitte aktivieren sie javascript
veuillez activer javascript
active javascript para ver esta página
domain has moved you will be redirected in a few seconds click here if that fails
checking that you are not a robot one moment please while we verify your browser
500 internal server error something broke on our side
service temporarily unavailable please try again later
you are offline reconnect and pull down to refresh
content unavailable in your region does not serve this to your network
certificate expired your connection is not private back to safety
warning could not reach data source fatal template missing
index of parent directory
this profile has not been filled in yet has not supplied a biography
under construction coming soon thank you for your patience
zero results for your query we could not find that scholar
oops that did not work go back or try the search box
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod
firstname surname job title goes here this is where a short biography goes replace this text with your own words
sample person sample biography sample link one
name_placeholder xxxxx xxxxx tbd tbc text to follow
insert biography max words insert list of publications
professor ______ studied at ______ and received a degree in ______
gateway timeout the upstream took too long to answer
this scholar has left the profile was taken down and its content is no longer available
página no encontrada el enlace que ha seguido no existe
seite nicht gefunden
page introuvable
undefined null object object
status 500 message internal failure trace""".split("\n")
# Phrases that tell such pages, as words, and signs of unfilled templates.
_PHRASES = """404|not found|nothing at this address|could not be located|access denied|do not have permission|forbidden|410|gone|sign in|login to|log in to|session has expired|session expired|session timed out
javascript|without scripts|has moved|redirected|not a robot|verify your browser|internal error|internal server error|internal failure|broke on our side|temporarily unavailable|offline|unavailable in your region
certificate|not private|fatal:|warning:|index of|parent directory|not been filled in|not supplied|under construction|coming soon|zero results|could not find|did not work|lorem|ipsum|firstname|goes here
sample person|sample biography|placeholder|text to follow|tbd|undefined|object object|insert biography|insert list|timeout|taken down|no encontrada|nicht gefunden|introuvable""".replace("\n", "|").split("|")
_SIGNS = re.compile(r"\{\{|\$\{|%[a-z_]+%|@@\w+@@|<\w+>|\"status\"|\[object|____+")


def _phrase_automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for p in _PHRASES:
        a.add_word(p, len(p))
    a.make_automaton()
    return a


_FOUND = _phrase_automaton()


def phrase_hits(low: str) -> int:
    """Occurrences of the phrases (as words) and signs in a text in lower case, the whole of it."""
    hits = len(_SIGNS.findall(low))
    for last, size in _FOUND.iter(low):
        s, e = last - size + 1, last + 1
        hits += not (s and low[s - 1].isalnum()) and not (low[e - 1].isalnum() and e < len(low) and low[e].isalnum())
    return hits


_WORD = re.compile(r"[^\W\d_]+|\d+|[{}$%<>@#\[\]]|_+")
_COURSE = re.compile(r"\W*[A-Z]{3,4} \d{3}")
_KNOWN = frozenset(w for words in COMMON.values() for w in words)
DENSE = 13



class _Codes(dict):
    """Hash of a word; all numbers are one word."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        c = self[word] = zlib.crc32(("0" if word.isdigit() else word).encode("utf-8", "replace"))
        return c


_codes = _Codes()


def _letters() -> str:
    """The ranges of ``[^\\W\\d_]`` below U+10000, which make a table of what are tests of each letter otherwise."""
    inside = [c != "_" and c.isalnum() and not c.isdecimal() for c in map(chr, range(1 << 16))] + [False]
    edges = [n for n in range(len(inside)) if inside[n] != inside[n - 1]]
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2], strict=True))


_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_WORD_BELOW = re.compile(_WORD.pattern.replace(r"[^\W\d_]", f"[{_letters()}]"))
_WORD_ASCII = re.compile(_WORD.pattern.replace(r"[^\W\d_]", "[a-zA-Z]"), re.A)


def words_of(low: str) -> list[str]:
    """``_WORD.findall(low)``, by an expression that is faster on the letters of ``low``."""
    return (_WORD_ASCII if low.isascii() else _WORD if _BEYOND.search(low) else _WORD_BELOW).findall(low)


def grams(words: list[str]) -> np.ndarray:
    """Distinct hashed 1- and 2-grams of lower-case words."""
    if not words:
        return np.zeros(0, dtype=np.int64)
    one = np.fromiter(map(_codes.__getitem__, words), dtype=np.int64, count=len(words))
    two = (one[:-1] * 31 + one[1:] * 17 + 7) & 0x7FFFFFFF
    held = np.zeros(1 << BITS, dtype=bool)
    held[one & ((1 << BITS) - 1)] = True
    held[two & ((1 << BITS) - 1)] = True
    return np.flatnonzero(held)


def left_over(text: str, kinds: list[tuple[int, str]]) -> tuple[list[str], bool]:
    """Lines that are neither menu, notice, box nor footer, and whether the person's line is among them."""
    raw = text.split("\n")
    return [raw[n].strip() for n, k in kinds if k in ("main", "name", "head", "marker")], any(k == "name" for _, k in kinds)


def features(text: str | None, name: str | None, title: str | None, kinds: list[tuple[int, str]] | None = None, recurrent: set[int] | frozenset[int] = frozenset()) -> tuple[np.ndarray, np.ndarray, int]:
    """(dense features, hashed grams, weak label: 1 residue, 0 content, -1 unknown)."""
    own = name_words(name or "")
    body = text or ""
    if kinds is None:
        kinds = elements(body, own, recurrent)
    lines, named = left_over(body, kinds)
    rest = "\n".join(lines)
    low = rest.lower()
    words = words_of(low)
    common = sum(map(_KNOWN.__contains__, words)) / max(len(words), 1)
    long = sum(1 for s in lines if len(s) >= 70)
    listed = sum(1 for s in lines if ("19" in s or "20" in s) and _YEARS.search(s) or _COURSE.match(s))
    position = any(has_position(s) for s in lines if len(s) < 120)
    marked = sum(1 for _, k in kinds if k == "marker") / max(len(lines), 1)
    t = (title or "").strip().lower()
    own_title = any(w in own for w in name_words(t))
    named = named and any(alike(w, o) for s in lines if len(s) < 80 for w in name_words(s) for o in own)
    hits = phrase_hits(low)
    dense = np.asarray(
        [
            1.0,
            np.log1p(len(rest)) / 5 - 1,
            float(len(rest) < 250),
            float(len(rest) > 900),
            float(named),
            float(position),
            min(long, 4) / 4,
            min(listed, 4) / 4,
            common * 2,
            marked,
            float(not t or t in ("untitled", "error")),
            float(own_title),
            min(1.0, 600 * hits / max(len(rest), 600)),  # how thick phrases of errors and templates stand
        ]
    )
    phrase = dense[12] > 0.5
    if not rest.strip():
        weak = 1
    elif phrase and not named and not position and listed < 2:
        weak = 1
    elif not named and not position and common < 0.08 and listed < 2 and len(words) > 15:
        weak = 1
    elif (named or position) and (long and common > 0.12 or listed >= 2):
        weak = 0
    else:
        weak = -1
    return dense, grams(words), weak


class Classifier:
    """Weights of the dense features and of the hashed grams."""

    def __init__(self, dense: np.ndarray, hashed: np.ndarray):
        self.dense, self.hashed = dense, hashed

    def score(self, dense: np.ndarray, hashed: np.ndarray, weak: int = -1) -> float:
        z = float(dense @ self.dense) + (float(self.hashed[hashed].sum()) / np.sqrt(len(hashed)) if len(hashed) else 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class WeakLabels:
    """What serves where no content is known to learn from: the weak label itself."""

    def score(self, dense: np.ndarray, hashed: np.ndarray, weak: int = -1) -> float:
        return 1.0 if weak == 1 else 0.0


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Classifier | WeakLabels:
    """Logistic regression with L2 by Adam; classes weigh the same. One class alone is not fitted."""
    if not any(r[2] == 0 for r in rows):
        return WeakLabels()
    seeds = []
    for s in SEEDS:
        d, g, _ = features(s, "", "")
        d[4:9], d[10] = [0, 0, 0, 0, d[8]], 1.0
        seeds.append((d, g, 1))
    used = [r for r in rows if r[2] >= 0] + seeds
    x = np.stack([r[0] for r in used])
    y = np.asarray([float(r[2]) for r in used])
    lengths = np.asarray([len(r[1]) for r in used])
    row = np.repeat(np.arange(len(used)), lengths)
    col = np.concatenate([r[1] for r in used])
    value = np.repeat(1.0 / np.sqrt(np.maximum(lengths, 1)), lengths)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    params = [np.zeros(x.shape[1]), np.zeros(1 << BITS)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        z = x @ params[0] + np.bincount(row, params[1][col] * value, minlength=len(used))
        g = weight * (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y)
        grads = [x.T @ g + L2 * params[0], np.bincount(col, g[row] * value, minlength=1 << BITS) + L2 * params[1]]
        for k in range(2):
            first[k] = 0.9 * first[k] + 0.1 * grads[k]
            second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
            params[k] = params[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Classifier(params[0], params[1])


def error_share(fetches: DataFrame) -> DataFrame:
    """(id, errors): share of a profile's fetches that were answered with a status of 400 or more."""
    status = F.try_element_at("fetch_info", F.lit("status")).try_cast("int")
    who = F.try_element_at("profile_context", F.lit("profile_id"))
    return fetches.select(who.alias("id"), (status >= 400).cast("int").alias("bad")).where("id is not null and bad is not null").groupBy("id").agg(F.avg("bad").alias("errors"))


def sample_rows(pages: DataFrame, fetches: DataFrame | None = None, max_train: int = MAX_TRAIN, lines: templates.Templates | None = None):
    """(host, dense, grams, weak) of the pages with the least hashes of their id, at most ``max_train``."""
    lines = lines or templates.Templates(pages)
    numbers = lines.numbers()
    least = pages.select("id").where("id is not null").orderBy(F.xxhash64("id"), "id").limit(max_train).distinct()
    columns = ["raw_text", "profile_name", "title", "profile_url"]
    sample = lines.mark(pages.select("id", *columns).join(F.broadcast(least), "id", "left_semi").groupBy("id").agg(F.max(F.struct(*columns)).alias("r")).select("id", "r.*"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [features(t, n, s, recurrent=numbers(r)) for t, n, s, r in zip(batch["raw_text"], batch["profile_name"], batch["title"], batch["_recurs"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "url": batch["profile_url"], "dense": [list(r[0]) for r in out], "grams": [list(r[1]) for r in out], "weak": [r[2] for r in out]})

    found = sample.mapInPandas(run, "id string, url string, dense array<double>, grams array<bigint>, weak int")
    if fetches is not None:
        # a page of unclear wording whose fetches mostly failed is taken for residue
        found = found.join(error_share(fetches), "id", "left").withColumn(
            "weak", F.when((F.col("weak") < 0) & (F.col("errors") > 0.5) & (F.col("dense")[4] == 0) & (F.col("dense")[5] == 0) & (F.col("dense")[2] == 1), 1).otherwise(F.col("weak"))
        )
    host = F.regexp_extract(F.lower("url"), "^[a-z]+://([^/:]+)", 1)
    rows = found.select(host.alias("host"), "id", "dense", "grams", "weak").collect()  # bounded by max_train
    rows.sort(key=lambda r: r.id)
    return [(r.host, np.asarray(r.dense), np.asarray(r.grams, dtype=np.int64), r.weak) for r in rows]


def fit(pages: DataFrame, fetches: DataFrame | None = None, max_train: int = MAX_TRAIN, lines: templates.Templates | None = None) -> Classifier | WeakLabels:
    return train([r[1:] for r in sample_rows(pages, fetches, max_train, lines)])


def validate(rows, folds: int = 5) -> dict[str, float]:
    """Agreement with the weak labels on hosts that the training didn't see; a fold that leaves one class to learn from is passed over."""
    right = total = hit = found = cases = 0
    for fold in range(folds):
        unseen = [zlib.crc32((r[0] or "").encode()) % folds == fold for r in rows]
        model = train([r[1:] for r, u in zip(rows, unseen, strict=True) if not u])
        for r, u in zip(rows, unseen, strict=True):
            if u and r[3] >= 0 and isinstance(model, Classifier):
                said = model.score(r[1], r[2]) >= CUT
                total += 1
                right += said == (r[3] == 1)
                found += said
                cases += r[3] == 1
                hit += said and r[3] == 1
    return {"rows": total, "accuracy": right / max(total, 1), "precision": hit / max(found, 1), "recall": hit / max(cases, 1)}


def scored(pages: DataFrame, fetches: DataFrame | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """(id, residue) of each record: the probability that it holds no content."""
    lines = templates.Templates(pages)
    numbers = lines.numbers()
    model = pages.sparkSession.sparkContext.broadcast(fit(pages, fetches, max_train, lines))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = [model.value.score(*features(text, name, title, recurrent=numbers(r))) for text, name, title, r in zip(batch["raw_text"], batch["profile_name"], batch["title"], batch["_recurs"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "residue": p})

    columns = pages.select("id", "profile_name", "title", "raw_text", "profile_url").where("id is not null")
    return lines.mark(spread(columns)).drop("profile_url").mapInPandas(run, "id string, residue double").groupBy("id").agg(F.max("residue").alias("residue"))


def residue(pages: DataFrame, fetches: DataFrame | None = None, cut: float = CUT) -> DataFrame:
    """Ids of the records that hold no content."""
    return scored(pages, fetches).where(F.col("residue") >= cut).select("id")
