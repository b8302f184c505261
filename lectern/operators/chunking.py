"""Cutting texts into chunks by words, characters, sentences and sections."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T

SIZE, OVERLAP_SHARE, TINY, MOST = 325, 0.15, 250, 400
#: Words as the JVM side splits them: at white space, no-break space included.
_WORD_RUN = re.compile("[^ \t\n\x0b\f\r\xa0]+")


def word_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE, overlap: float = OVERLAP_SHARE) -> DataFrame:
    """(id, chunk_no, words, chunk) of windows of ``size`` words that share ``overlap`` of them.

    A window starts every step while words are left, so the last may be overlap only.
    Texts without words give none.
    """
    step = max(1, size - max(1, int(size * overlap)))
    words = F.filter(F.split(T.collapsed(F.col(text)), " "), lambda w: w != "")
    split = docs.select(F.col(id_col), words.alias("w")).where("size(w) > 0")
    at = split.select(id_col, "w", F.posexplode(F.sequence(F.lit(1), F.size("w"), F.lit(step))).alias("chunk_no", "s"))
    part = F.slice("w", F.col("s"), F.lit(size))
    return at.select(id_col, "chunk_no", F.size(part).alias("words"), F.array_join(part, " ").alias("chunk"))


def merged_tail(chunks: DataFrame, id_col: str = "doc_id", tiny: int = TINY, most: int = MOST) -> DataFrame:
    """Word windows of which a tiny last one is joined to the one before if both together aren't too long.

    Works on the chunk arrays of a document, without a window over the document.
    """
    listed = chunks.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("chunk_no", "words", "chunk"))).alias("c"))

    def join(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        fits = (F.size(acc) > 0) & (x["words"] < tiny) & (last["words"] + x["words"] <= most)
        longer = F.struct(last["chunk_no"].alias("chunk_no"), (last["words"] + x["words"]).alias("words"), F.concat_ws(" ", last["chunk"], x["chunk"]).alias("chunk"))
        return F.when(fits, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(x)))

    empty = F.array().cast("array<struct<chunk_no:int,words:int,chunk:string>>")
    return listed.select(id_col, F.explode(F.aggregate("c", empty, join)).alias("x")).select(id_col, "x.*")


def char_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 1000, overlap: int = 120) -> DataFrame:
    """(id, chunk_no, start, chunk) of windows of ``size`` characters; the last one ends with the text."""
    step = size - overlap
    n = F.length(text)
    count = F.when(n <= size, 1).otherwise(F.ceil((n - size) / step).cast("int") + 1)
    at = docs.where(n > 0).select(id_col, text, F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk_no"))
    return at.select(id_col, "chunk_no", (F.col("chunk_no") * step).alias("start"), F.substring(F.col(text), F.col("chunk_no") * step + 1, F.lit(size)).alias("chunk"))


def sentence_packs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """(id, chunk_no, words, chunk) of whole sentences packed up to ``most`` words; a longer sentence stands alone."""
    listed = docs.select(F.col(id_col), T.sentences(F.col(text)).alias("s")).where("size(s) > 0")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, sentences in zip(batch[id_col], batch["s"], strict=True):
                pack: list[str] = []
                size = n = 0
                for s in sentences:
                    words = len(s.split())
                    if pack and size + words > most:
                        out.append((key, n, size, " ".join(pack)))
                        pack, size, n = [], 0, n + 1
                    pack.append(s)
                    size += words
                if pack:
                    out.append((key, n, size, " ".join(pack)))
            yield pd.DataFrame(out, columns=[id_col, "chunk_no", "words", "chunk"])

    return listed.mapInPandas(run, f"{id_col} {kind}, chunk_no int, words int, chunk string")


def boundary_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 2000, overlap: int = 200, search: int = 500) -> DataFrame:
    """Windows of characters that end after the last sentence end within the final ``search`` characters, else at ``size``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, t in zip(batch[id_col], batch[text], strict=True):
                a = n = 0
                while t and a < len(t):
                    b = min(len(t), a + size)
                    if b < len(t):
                        found = max((t.rfind(e, b - search, b) for e in (". ", "! ", "? ", ".\n", "\n\n")), default=-1)
                        b = found + 1 if found > a + overlap else b
                    out.append((key, n, a, t[a:b]))
                    if b >= len(t):
                        break
                    a, n = max(b - overlap, a + 1), n + 1
            yield pd.DataFrame(out, columns=[id_col, "chunk_no", "start", "chunk"])

    return docs.select(id_col, text).where(F.length(text) > 0).mapInPandas(run, f"{id_col} {kind}, chunk_no int, start int, chunk string")


def listy(chunk: Column) -> Column:
    """Whether a chunk is chrome: short, mostly short or bulleted lines, or few letters."""
    lines = T.lines_of(chunk)
    bullets = F.size(F.filter(lines, lambda s: s.rlike(r"^[-*•>|]") | (F.length(s) < 30)))
    return (F.length(chunk) < 120) | ((F.size(lines) >= 6) & (bullets / F.greatest(F.size(lines), F.lit(1)) >= 0.6)) | (F.regexp_count(chunk, F.lit(r"\p{L}")) / F.greatest(F.length(chunk), F.lit(1)) < 0.5)


def placed(t: str, chunks: list[str], anchor: int = 6) -> list[tuple[int, int]]:
    """(start, end) of each chunk in a text, in order; (-1, -1) if not found.

    A chunk is sought as the run of its words, after the first word of the chunk before.
    If it isn't there as a run, its first words, from ``anchor`` down to two, tell its
    start, and its last words after them its end.
    """
    spans = [m.span() for m in _WORD_RUN.finditer(t)]
    words = [t[a:b] for a, b in spans]
    where: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        where.setdefault(w, []).append(i)

    def run(of: list[str], begin: int) -> int | None:
        at = where.get(of[0], ())
        return next((i for i in at[bisect.bisect_left(at, begin) :] if words[i : i + len(of)] == of), None) if at else None

    out, begin = [], 0
    for chunk in chunks:
        of = _WORD_RUN.findall(chunk)
        if not of:
            out.append((-1, -1))
            continue
        i = run(of, begin)
        last = None if i is None else i + len(of) - 1
        if i is None:
            head = next(((k, j) for k in range(min(anchor, len(of)), min(1, len(of) - 1), -1) if (j := run(of[:k], begin)) is not None), None)
            if head is None:
                out.append((-1, -1))
                continue
            k, i = head
            tail = run(of[-min(anchor, len(of)) :], i)
            last = min(len(words), i + len(of)) - 1 if tail is None else tail + min(anchor, len(of)) - 1
        out.append((spans[i][0], spans[last][1]))
        begin = i + 1
    return out


def offsets(chunks: DataFrame, docs: DataFrame, id_col: str = "doc_id", text: str = "text", anchor: int = 6) -> DataFrame:
    """(id, chunk_no, start, end) of each chunk in its text, by :func:`placed`; -1 if not found."""
    listed = chunks.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("chunk_no", "chunk"))).alias("c")).join(docs.select(id_col, text), id_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, parts, t in zip(batch[id_col], batch["c"], batch[text], strict=True):
                at = placed(t or "", [p["chunk"] or "" for p in parts], anchor)
                out.extend((key, p["chunk_no"], *x) for p, x in zip(parts, at, strict=True))
            yield pd.DataFrame(out, columns=[id_col, "chunk_no", "start", "end"])

    return listed.mapInPandas(run, f"{id_col} {kind}, chunk_no int, start int, end int")


def section_spans(docs: DataFrame, id_col: str = "id", text: str = "raw_text") -> DataFrame:
    """(id, section_no, heading, kind, first_line, last_line) of each section, by its heading lines.

    A heading starts with #, ends with a colon or is in capitals, with at most five
    words. A section ends where the next begins.
    """
    lines = F.split(F.col(text), "\n")
    marked = F.transform(lines, lambda s, i: F.struct(i.alias("line"), F.trim(F.regexp_replace(s, "\r", "")).alias("s")))
    heads = F.filter(
        marked,
        lambda x: (x["s"] != "") & (F.size(F.split(x["s"], " ")) <= 5) & (x["s"].rlike("^#{1,4} ") | x["s"].rlike(r"^[^.:]{3,40}:$") | x["s"].rlike(r"^[A-Z][A-Z &]{3,40}$")),
    )
    found = docs.select(id_col, F.size(lines).alias("n"), heads.alias("h")).select(id_col, "n", "h", F.posexplode("h").alias("section_no", "x"))
    following = F.try_element_at("h", F.col("section_no") + 2)
    title = F.lower(F.trim(F.regexp_replace("x.s", r"^#+|:$", "")))
    return found.select(id_col, "section_no", title.alias("heading"), section_kind(title).alias("kind"), F.col("x.line").alias("first_line"), (F.coalesce(following["line"], F.col("n")) - 1).alias("last_line"))


def section_kind(title: Column) -> Column:
    """What a section is about, by the words of its heading."""
    return (
        F.when(title.rlike("publication|papers|books"), "publications")
        .when(title.rlike("award|honou?r|prize"), "awards")
        .when(title.rlike("education|degree|parcours|trayectoria|lebenslauf"), "education")
        .when(title.rlike("teach|course|lehre|docencia|enseignement"), "teaching")
        .when(title.rlike("research|project|forschung|investigaci|recherche"), "research")
        .when(title.rlike("bio|about|overview|zur person"), "biography")
        .when(title.rlike("service"), "service")
        .when(title.rlike("contact"), "contact")
        .otherwise("other")
    )


# ---------------------------------------------------------------- further cutters

# Verbs that lead a sentence about a person.
NARRATIVE = r"(?:^|[.\n!?])\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})\s+(?:is|was|wrote|serves?|served|teaches?|taught|argues?|argued|studies|studied|founded|leads?|led|directs?|directed|holds?|earned|graduated|published|received|focuses?|works?|joined)\b"
OTHER_SUBJECT = r"(?:^|[.\n])\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)\s+(?:was|is|earned|served|founded|published|received|wrote|graduated|holds|completed)\b"


def _mapped(docs: DataFrame, id_col: str, text: str, cut, columns: str) -> DataFrame:
    """Rows of ``cut(text)`` with their number, by Arrow batches; null and empty texts give none."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "chunk_no", *[c.split()[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(key, n, *row) for key, t in zip(batch[id_col], batch[text], strict=True) for n, row in enumerate(cut(t))]
            yield pd.DataFrame(out, columns=names)

    return docs.select(id_col, text).where(F.length(text) > 0).mapInPandas(run, f"{id_col} {kind}, chunk_no int, {columns}")


def mid_sentences(text: Column, least: int = 50, most: int = 280) -> Column:
    """Sentences of a middle length, with single blanks."""
    return F.filter(F.transform(T.sentences(text), T.collapsed), lambda s: F.length(s).between(least, most))


def section_packs(sentences: list[str], target: int = SIZE, least: int = TINY, most: int = MOST) -> list[tuple[int, str]]:
    """(words, chunk) of sentences packed towards ``target`` words: a pack of ``least`` ends before a sentence that would reach the target, any before one that would pass ``most``; a small rest joins the last pack if it fits."""
    packs: list[list[str]] = []
    now: list[str] = []
    size = 0
    for s in sentences:
        n = len(s.split())
        if now and (size + n > most or (size + n >= target and size >= least)):
            packs.append(now)
            now, size = [], 0
        now.append(s)
        size += n
    if now:
        if packs and size < least and sum(len(s.split()) for s in packs[-1]) + size <= most:
            packs[-1] += now
        else:
            packs.append(now)
    return [(sum(len(s.split()) for s in p), " ".join(p)) for p in packs]


def section_combined(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, chunk_no, words, chunk) by :func:`section_packs` over the sentences of each text."""
    listed = docs.select(id_col, T.sentences(F.col(text)).alias("s")).where("size(s) > 0")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(k, n, *p) for k, s in zip(batch[id_col], batch["s"], strict=True) for n, p in enumerate(section_packs(list(s)))], columns=[id_col, "chunk_no", "words", "chunk"])

    return listed.mapInPandas(run, f"{id_col} {kind}, chunk_no int, words int, chunk string")


def semantic_packs(sentences: list[str], size: int = 1000, overlap: int = 100) -> list[tuple[int, str]]:
    """(sentences, chunk) of at most ``size`` characters of whole sentences, each beginning with the last ones of the chunk before that fit ``overlap``."""
    out: list[tuple[int, str]] = []
    now: list[str] = []
    n = 0
    for s in sentences:
        if now and n + len(s) > size:
            out.append((len(now), " ".join(now)))
            kept: list[str] = []
            n = 0
            for x in reversed(now if len(now) > 1 else []):
                if n + len(x) > overlap:
                    break
                kept.insert(0, x)
                n += len(x) + 1
            now = kept
        now.append(s)
        n += len(s) + 1
    if now:
        out.append((len(now), " ".join(now)))
    return out


def semantic_chunks(docs: DataFrame, id_col: str = "id", text: str = "raw_text", size: int = 1000, overlap: int = 100) -> DataFrame:
    """(id, section_no, kind, chunk_no, sentences, chunk): each section of a text (:func:`section_spans`) cut by :func:`semantic_packs`; a text without sections is one."""
    spans = section_spans(docs, id_col, text)
    lines = F.split(F.col(text), "\n")
    whole = docs.select(id_col, lines.alias("l"))
    cut = whole.join(spans.select(id_col, "section_no", "kind", "first_line", "last_line"), id_col, "left")
    part = F.when(F.col("section_no").isNull(), F.col("l")).otherwise(F.slice("l", F.col("first_line") + 1, F.greatest(F.col("last_line") - F.col("first_line") + 1, F.lit(0))))
    rows = cut.select(id_col, F.coalesce("section_no", F.lit(0)).alias("section_no"), F.coalesce("kind", F.lit("other")).alias("kind"), T.sentences(F.array_join(part, "\n")).alias("s")).where("size(s) > 0")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(i, n, k, c, *p) for i, n, k, s in zip(b[id_col], b["section_no"], b["kind"], b["s"], strict=True) for c, p in enumerate(semantic_packs(list(s), size, overlap))], columns=[id_col, "section_no", "kind", "chunk_no", "sentences", "chunk"])

    return rows.mapInPandas(run, f"{id_col} {kind}, section_no int, kind string, chunk_no int, sentences int, chunk string")


def seventy_cut(text: str, size: int = 1000, share: float = 0.7) -> list[tuple[int, str]]:
    """(start, chunk) of at most ``size`` characters that end with a sentence if one ends beyond ``share`` of the size."""
    out, a = [], 0
    while a < len(text):
        b = min(a + size, len(text))
        if b < len(text):
            found = max(text.rfind(e, a, b) for e in (". ", "! ", "? ", "\n\n")) - a
            if found > size * share:
                b = a + found + 1
        if text[a:b].strip():
            out.append((a, text[a:b]))
        a = b
    return out


def seventy_chunks(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 1000) -> DataFrame:
    """(id, chunk_no, start, chunk) by :func:`seventy_cut`."""
    return _mapped(docs, id_col, text, lambda t: seventy_cut(t, size), "start int, chunk string")


def token_chunks(docs: DataFrame, encode, decode, id_col: str = "doc_id", text: str = "text", most: int = 400, overlap: int = 40, search: int = 500) -> DataFrame:
    """(id, chunk_no, first_token, tokens, chunk) of at most ``most`` tokens that end with a sentence within the last ``search`` characters, ``overlap`` tokens shared.

    ``encode`` and ``decode`` are functions of a tokenizer, made where they run.
    """

    def cut(t: str) -> list[tuple[int, int, str]]:
        codes = encode(t)
        out, a = [], 0
        while a < len(codes):
            b = min(a + most, len(codes))
            if b < len(codes):
                said = decode(codes[a:b])
                end = next((i for i in range(len(said) - 1, max(len(said) - search, 0), -1) if said[i] in ".!?\n"), None)
                if end is not None:
                    b = a + max(1, min(len(encode(said[: end + 1])), b - a))
            out.append((a, b - a, decode(codes[a:b])))
            if b >= len(codes):
                break
            a = max(b - overlap, a + 1)
        return out

    return _mapped(docs, id_col, text, cut, "first_token int, tokens int, chunk string")


def mentions_subject(text: Column, name: Column) -> Column:
    """Whether a chunk names its subject and no other person leads two sentences more than the subject."""
    low = F.lower(text)
    parts = F.filter(F.split(F.lower(F.trim(name)), " "), lambda w: F.length(w) >= 3)

    def check(p: Column) -> Column:
        first, last, whole = F.try_element_at(p, F.lit(1)), F.try_element_at(p, F.lit(-1)), F.lower(F.trim(name))
        hit = low.contains(whole) | low.contains(last) | (low.contains(first) & F.exists(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), lambda w: low.contains(w)))
        leaders = F.transform(F.regexp_extract_all(text, F.lit(NARRATIVE), 1), F.lower)

        def led(ls: Column) -> Column:
            others = F.filter(ls, lambda x: ~x.contains(last) & ~x.contains(whole))
            top = T.let(others, lambda o: F.coalesce(F.array_max(F.transform(F.array_distinct(o), lambda x: F.size(F.filter(o, lambda y: y == x)))), F.lit(0)))
            return T.let(top, lambda n: (n >= 2) & (n - (F.size(ls) - F.size(others)) >= 2))

        return F.coalesce(hit & ~T.let(leaders, led), F.lit(False))

    return F.when((F.coalesce(text, F.lit("")) == "") | (F.coalesce(name, F.lit("")) == "") | (F.size(parts) <= 0), False).otherwise(T.let(parts, check))


def continues_subject(text: Column, name: Column) -> Column:
    """Whether a chunk goes on about a subject: third-person pronouns, and no other person's full name leading a sentence."""
    other = F.lower(F.regexp_extract(text, OTHER_SUBJECT, 1))
    n = F.lower(F.coalesce(name, F.lit("")))
    stranger = (other != "") & ~n.contains(other) & ~F.exists(F.split(other, r"\s+"), lambda w: n.contains(w))
    return F.coalesce(~stranger & F.lower(text).rlike(r"(?:^|[^a-z])(?:he|she|his|her|him|hers)(?:[^a-z]|$)"), F.lit(False))


def subject_chunks(chunks: DataFrame, id_col: str, name: str, quality: Column, number: str = "chunk_no", text: str = "chunk") -> DataFrame:
    """The chunks that are about their subject: those that name it, and one right after such a one that goes on about it; hosts of low value keep only the former.

    Windows run within one text.
    """
    from pyspark.sql.window import Window

    said = chunks.withColumn("subject", mentions_subject(F.col(text), F.col(name)))
    last = F.last(F.when(F.col("subject"), F.col(number)), ignorenulls=True).over(Window.partitionBy(id_col).orderBy(number).rowsBetween(Window.unboundedPreceding, 0))
    near = F.col(number) - F.coalesce(last, F.lit(-10)) <= 1
    return said.where("subject").unionByName(said.withColumn("_near", near).where(F.col("_near") & ~F.col("subject") & (quality >= 0) & continues_subject(F.col(text), F.col(name))).drop("_near"))


def noise_segment(text: Column) -> Column:
    """Whether a segment is mostly bot walls, references, page counters or digits, so that it isn't worth a model's time."""
    from lectern.functions import cleaning as C

    t = C.strip(F.coalesce(text, F.lit("")))
    low, digits = F.lower(t), F.regexp_count(t, F.lit("[0-9]"))
    return (t == "") | low.rlike(C.BOT) | low.rlike(C.REFERENCE) | (F.regexp_count(low, F.lit(C.PAGE_OF)) >= 6) | ((digits >= 80) & (F.regexp_count(t, F.lit(r"\p{L}")) <= digits))


def embedded(rows: DataFrame, text: str, embed, size: int, out: str = "embedding", batch: int = 50) -> DataFrame:
    """``rows`` with a vector of each text by ``embed``, a function from a list of texts to a list of vectors, called for ``batch`` texts at a time where the rows are.

    Null and blank texts get null; a vector of another size is an error.
    """
    import pyspark.sql.types as t

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            found: list = [None] * len(s)
            told = [i for i, x in enumerate(s) if isinstance(x, str) and x.strip()]
            for a in range(0, len(told), batch):
                part = told[a : a + batch]
                for i, v in zip(part, embed([s.iloc[i] for i in part]), strict=True):
                    if len(v) != size:
                        raise ValueError(f"a vector of {len(v)} numbers where {size} were expected")
                    found[i] = [float(x) for x in v]
            yield pd.Series(found)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return rows.withColumn(out, F.pandas_udf(run, t.ArrayType(t.DoubleType()))(F.col(text)))


def semantic_cuts(sentences: list[str], vectors: list[list[float]], drop: float = 0.3) -> list[int]:
    """Places before which a new part begins: where the cosine of two neighbours falls by ``drop`` below the mean of all neighbours."""
    import numpy as np

    if len(sentences) < 3:
        return []
    v = np.asarray(vectors, dtype=float)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    near = (v[:-1] * v[1:]).sum(1)
    return [int(i) + 1 for i in np.flatnonzero(near < near.mean() - drop)]
