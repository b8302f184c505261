"""Problem 10: statistics of each text, and how far they lie from natural prose.

Each document gets a vector of statistics. For each language the mean and the
covariance of the statistics of labelled prose are estimated robustly (outlying
prose is trimmed and the estimate repeated), shrunk towards those of all prose.
The squared Mahalanobis distance of a document, and the share of it that each
statistic contributes, say how far and why it departs from prose. The cut is the
distance that parts the labelled documents best.

Statistics saturate where prose is at its ease (a line longer than a sentence, a
share of common words beyond a third), so that only departures towards lists,
tables and damage count.

Defined cases: null and blank texts have all statistics 0; they and texts without
any word are not prose;
languages are told from the text, not from the language column; a language with
few labels leans on the pooled estimate; without any prose label there is no
distance (null) and every text with a word passes as prose; ties at the cut are prose;
repeated labels of a document count once, the greatest; empty tables give no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import spread, stored

#: Labelled documents that the estimate may use at most; a bounded sample by design.
MAX_LABELS = 20_000
#: Prose documents that the pooled estimate counts for within a language.
SHRINK = 60.0
TRIM, ROUNDS = 0.02, 3

# Common words of each language.
COMMON = {
    "en": "the of and to a in is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over me even most made after also did many before must through back where much your way well down should because each just those people how too little state good very make world still own see men work long here get both between life being under never day same another know while last might us great old year off come since against go came right used take three".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde wer wir hier seit gegenseitig dieser diese dieses viele damit dazu dabei kann alle wenn was ihre ihr zwischen unter gegen".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son sa aux ces mais comme on nous vous leur été cette fait ont être elle après sans très entre même deux depuis ans car tout peu aussi bien où dont si".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque qué sólo han yo hay vez puede todos así nos ni parte tiene uno donde bien tiempo mismo ese ahora cada vida otro después te otros aunque esa eso hace otra gobierno tan durante siempre día tanto ella tres sí tras".split(),
}

STATS = (
    "common_share",
    "common_spread",
    "word_chars",
    "letter_share",
    "digit_share",
    "symbol_share",
    "damage_share",
    "line_words",
    "line_ends",
    "list_lines",
    "capital_share",
    "repeat_share",
    "length",
    "mean_word",
)

_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_DAMAGE = re.compile("[�\x00-\x08\x0b\x0c\x0e-\x1f]|Ã.|Â.|â€.|ï¿½")
_LISTED = re.compile(r"^\s*(?:[-*•>›<|{\[+#]|\(?\d+[.):\s]|https?://|\w+[:=]\s)|[|;\t]")
_END = (".", "!", "?", "…", "。", ":", '"', "”", "»", ")")
_SYMBOLS = str.maketrans("", "", "{}[]<>|\\/=+*^~#@$%&_;")


def _language_of(found: list[str], sets: dict[str, frozenset]) -> tuple[str, int]:
    best, most = "en", -1
    for lang, words in sets.items():
        n = sum(map(words.__contains__, found))
        if n > most:
            best, most = lang, n
    return best, most


def _compressed_share(text: str, block: int = 1 << 16) -> float:
    """Compressed bytes of the whole text for each of its bytes, a block at a time."""
    pack = zlib.compressobj(1)
    size = packed = 0
    for a in range(0, len(text), block):
        raw = text[a : a + block].encode("utf-8", "replace")
        size += len(raw)
        packed += len(pack.compress(raw))
    return (packed + len(pack.flush())) / max(size, 1)


def stats(text: str | None, sets: dict[str, frozenset]) -> tuple[str, int, list[float]]:
    """(language, number of words, statistics in the order of STATS)."""
    if not text or not text.strip():
        return "en", 0, [0.0] * len(STATS)
    n = len(text)
    found = _WORD.findall(text)
    m = len(found)
    low = [w.lower() for w in found]
    lang, common = _language_of(low, sets)
    words_chars = sum(map(len, found))
    digits = len(re.findall(r"\d", text))
    spaces = text.count(" ") + text.count("\n") + text.count("\t") + text.count("\r") + text.count("\xa0")
    solid = max(n - spaces, 1)
    symbols = n - len(text.translate(_SYMBOLS))
    damage = sum(map(len, _DAMAGE.findall(text)))
    lines = [s for s in text.split("\n") if s.strip()]
    # weighted by length: what most characters stand in decides
    chars = sum(map(len, lines))
    ended = sum(len(s) for s in lines if s.rstrip().endswith(_END))
    listed = sum(len(s) for s in lines if _LISTED.search(s))
    line_words = sum(len(s) * min(len(s.split()), 12) for s in lines) / max(chars, 1) / 12
    # spread: share of windows of 12 words that hold a common word of the language
    known = sets[lang]
    flags = [w in known for w in low]
    windows = [any(flags[i : i + 8]) + (sum(flags[i : i + 8]) > 1) for i in range(0, max(m - 3, 1), 8)] if m else [0]
    capital = sum(1 for a, w in zip(text_before(found), found, strict=True) if w[0].isupper() and a) if m else 0
    ratio = _compressed_share(text)
    return (
        lang,
        m,
        [
            min(common / max(m, 1) / 0.3, 1.0),
            sum(windows) / len(windows) / 2,
            min(words_chars / solid / 0.9, 1.0),
            min(words_chars / n / 0.75, 1.0),
            min(digits / solid * 4, 1.0),
            min(symbols / solid * 8, 1.0),
            min(damage / solid * 8, 1.0),
            min(line_words * 1.2, 1.0),
            ended / max(chars, 1) if m > 12 and len(lines) > 2 else 1.0,
            listed / max(chars, 1),
            capital / max(m, 1) if sum(w.isupper() for w in found) < 0.5 * m else 0.1,
            max(0.0, 0.12 - ratio) * 8 if n > 300 else 0.0,
            min(np.log1p(m) / 4, 1.0),
            min(abs(words_chars / max(m, 1) - 5.5), 6.0) / 6,
        ],
    )


def text_before(found: list[str]) -> list[bool]:
    """Which words follow another word (all but the first)."""
    return [False] + [True] * (len(found) - 1)


def doc_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, language, n_words, stats) of each document; texts are not shuffled."""
    sets = {k: frozenset(v) for k, v in COMMON.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [stats(t, sets) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "language": [r[0] for r in rows], "n_words": [r[1] for r in rows], "stats": [r[2] for r in rows]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInPandas(run, f"doc_id {kind}, language string, n_words int, stats array<double>")


class ProseModel:
    """Robust mean and covariance of prose in each language, and the cut."""

    #: Added to each variance: differences below this scale (squared) don't count.
    FLOOR = 0.03**2

    def __init__(self, values: np.ndarray, languages: np.ndarray, prose: np.ndarray):
        if not prose.any():
            raise ValueError("the estimate needs documents labelled as prose")
        pooled = self._robust(values[prose])
        self.of: dict[str, tuple[np.ndarray, np.ndarray]] = {"": self._inverted(*pooled)}
        for lang in np.unique(languages[prose]):
            own = values[prose & (languages == lang)]
            mean, cov = self._robust(own) if len(own) > len(STATS) else (own.mean(0), np.zeros((len(STATS), len(STATS))))
            n = len(own)
            blend = n / (n + SHRINK)
            self.of[str(lang)] = self._inverted(blend * mean + (1 - blend) * pooled[0], blend * cov + (1 - blend) * pooled[1])
        self.cut = self._cut(self.distances(values, languages), prose)

    @staticmethod
    def _robust(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and covariance after the farthest ``TRIM`` are left out, ``ROUNDS`` times."""
        kept = x
        for _ in range(ROUNDS):
            mean, cov = kept.mean(0), np.cov(kept, rowvar=False) if len(kept) > 1 else np.zeros((x.shape[1],) * 2)
            inverse = np.linalg.inv(cov + ProseModel.FLOOR * np.eye(len(mean)))
            d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
            kept = x[d <= np.quantile(d, 1 - TRIM)]
        return mean, cov

    @staticmethod
    def _inverted(mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return mean, np.linalg.inv(cov + ProseModel.FLOOR * np.eye(len(mean)))

    @staticmethod
    def _cut(d: np.ndarray, prose: np.ndarray) -> float:
        """The distance between labelled documents that parts the classes with the fewest errors."""
        if prose.all():
            return float(d.max()) * 1.5 + 1.0
        order = np.argsort(d, kind="stable")
        d, p = d[order], prose[order]
        wrong = np.cumsum(~p) + (p.sum() - np.cumsum(p))
        best = np.flatnonzero(wrong == wrong.min())
        i = best[len(best) // 2]
        return float(np.sqrt(d[i] * d[i + 1])) if i + 1 < len(d) else float(d[i])

    def parts(self, values: np.ndarray, languages: np.ndarray) -> np.ndarray:
        """Contribution of each statistic; they add up to the squared distance."""
        out = np.empty_like(values, dtype=float)
        for lang in np.unique(languages):
            rows = np.flatnonzero(languages == lang)
            mean, inverse = self.of.get(str(lang), self.of[""])
            z = values[rows] - mean
            out[rows] = z * (z @ inverse)
        return out

    def distances(self, values: np.ndarray, languages: np.ndarray) -> np.ndarray:
        return self.parts(values, languages).sum(1)


def fit(measured: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> ProseModel | None:
    """The model from labelled documents, at most ``max_labels`` of them, lowest hash of the id first; None without prose labels."""
    one = labels.where("doc_id is not null and is_prose is not null").groupBy("doc_id").agg(F.max("is_prose").alias("is_prose"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    rows = measured.join(F.broadcast(sample), "doc_id").select("language", "stats", "is_prose").collect()  # bounded by max_labels
    if not any(r.is_prose == 1 for r in rows):
        return None
    values = np.asarray([r.stats for r in rows])
    order = np.lexsort(values.T)
    return ProseModel(values[order], np.asarray([r.language for r in rows])[order], np.asarray([r.is_prose == 1 for r in rows])[order])


def scored(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """Per document: its statistics, the distance from prose, each statistic's share, and the verdict."""
    measured = stored(doc_stats(docs.where("doc_id is not null")), "p10-stats")
    model = docs.sparkSession.sparkContext.broadcast(fit(measured, labels, max_labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{s} double" for s in STATS) + ", " + ", ".join(f"{s}_part double" for s in STATS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            values = np.stack(batch["stats"].to_numpy())
            blank = batch["n_words"].to_numpy() == 0
            if model.value is None:
                parts = np.full(values.shape, np.nan)
                distance, fits = None, ~blank
            else:
                parts = model.value.parts(values, batch["language"].to_numpy().astype(str))
                distance = parts.sum(1)
                fits = (distance <= model.value.cut) & ~blank
            out = batch[["doc_id", "language", "n_words"]].assign(distance=distance, is_prose=fits)
            yield pd.concat([out.reset_index(drop=True), pd.DataFrame(values, columns=STATS), pd.DataFrame(parts, columns=[f"{s}_part" for s in STATS])], axis=1)

    return measured.mapInPandas(run, f"doc_id {kind}, language string, n_words int, distance double, is_prose boolean, {columns}")


def not_prose(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Ids of the documents that are not natural prose."""
    return scored(docs, labels).where("not is_prose").select("doc_id").distinct()
