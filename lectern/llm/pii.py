"""Problem 4: personal details in free text, found and replaced by placeholders.

Emails, telephone and identity numbers and postal addresses are found by their
formats, numbers without a label only if their numbering plan allows them
(:mod:`lectern.llm.numbers`). Persons' names are found by given names (a fixed list,
those learnt from the profile names, and those of the page's own person) or initials
next to a family name, or by a title before them. Each item is replaced by a
placeholder of its kind. Numbers and dates that validate keep their format: their
digits are permuted by a keyed Feistel network, check digits are made anew, so equal
values get equal pseudonyms in every document, the pseudonym validates as well, and
whoever holds the key can undo it. Other items carry a keyed tag that links equal
values. The key comes from the caller.

Defined cases: null and empty texts have no items and stay as they are; overlapping
finds keep the earlier kind in the order of ``KINDS``; an item that stands several
times in a text is one row of the finds and is replaced everywhere; a repeated row
counts once; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import numbers
from lectern.operators.dedup import one_per_key
from lectern.operators.joins import sized_semi_join
from lectern.session import spread, stored

KINDS = ("email", "id_number", "address", "phone", "person_name")
#: Profiles that must share a first name with different last names to have it learnt.
LEARN_FROM = 3
#: Times that a learnt given name stands first for each time that it stands last.
FIRST_TO_LAST = 3
#: Learnt names up to which every task holds them all; beyond, each page gets those of its own words by a join.
MAX_LEARNT = 500_000

# Common given names of many countries; others are learnt from the profile names.
GIVEN = """James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen
Christopher Lisa Daniel Nancy Matthew Betty Anthony Margaret Mark Sandra Donald Ashley Steven Emily Paul Kimberly Andrew Donna Joshua Michelle Kenneth Carol
Kevin Amanda Brian Dorothy George Melissa Edward Deborah Ronald Stephanie Timothy Rebecca Jason Laura Jeffrey Helen Ryan Sharon Jacob Cynthia Gary Kathleen
Nicholas Amy Eric Angela Jonathan Anna Stephen Ruth Larry Emma Justin Alice Scott Julia Brandon Victoria Benjamin Samuel Gregory Alexander Patrick Peter Ann Anne
Hans Klaus Jürgen Wolfgang Stefan Andreas Ursula Monika Petra Sabine Heike Ulrich Jean Pierre Michel Philippe Marie Nathalie Isabelle Sylvie François
José Antonio Manuel Francisco Luis Carmen Ana Isabel María Dolores Giuseppe Giovanni Paolo Francesca Chiara Mohammed Ahmed Ali Omar Fatima Aisha Mehmet Ayşe Hassan
Rahul Priya Sanjay Anil Sunita Ravi Deepak Wei Xiaoming Hiroshi Yuki Takashi Kenji Haruka Min-jun Ji-woo Seo-yeon Oluwaseun Chinedu Kwame Amina Ngozi Thabo
Ivan Dmitri Sergei Olga Natalia Tatiana Piotr Katarzyna Jana Lars Erik Anders Ingrid Astrid Søren Maarten Eva""".split()

# Words that no family name is, and words that make a name one of a thing.
_NOT_FAMILY = frozenset(
    "the this that these those in on at of for and or by from with a an to is was are were box after before since when what who why how it its their they he she we you i university college institute department school centre center lab laboratory hall street road lane avenue foundation fund prize award project group unit office press library journal review symposium workshop society professor prof dr phd md assistant associate senior adjunct clinical research room phd msc monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december".split()
)
_THING = frozenset("lab laboratory hall building street road lane avenue foundation fund prize award university college institute centre center library project archive wing trail lecture medal station chair scholarship consortium".split())

_UP = "A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĘĚĞĢĪĮİĶĹĽŁŃŅŇŐŒŘŚŞŠŢŤŪŮŰŲŹŻŽ"
_FAMILY = rf"[{_UP}][^\W\d_]+(?:['’][^\W\d_]+)*(?:-[{_UP}][^\W\d_]+)*"
_GAP = r"[ \t\xa0]+"
_AFTER = re.compile(rf"((?:{_GAP}(?:[{_UP}]\.(?:-[{_UP}]\.)?|[{_UP}](?=[ \xa0])))*){_GAP}({_FAMILY})")
_INITIALS = re.compile(rf"(?<![\w.&@-])([{_UP}]\.(?:[ \xa0-]?[{_UP}]\.){{0,3}})[ \xa0]+({_FAMILY})")
_INITIALS_AFTER = re.compile(rf"(?:{_GAP}[{_UP}]\.?(?![\w]))+")
_ONE_FAMILY = re.compile(_FAMILY)
_ONE_GAP = r"[ \xa0]"
_TITLED = re.compile(rf"(?:\b(?:Prof|Professor|Dr|Doctor|Mr|Mrs|Ms|Herr|Frau|Mme|Monsieur|Madame|Señora?|Sra?|Doña|Don)\b\.?{_ONE_GAP}|\b[Cc]ontact:?{_ONE_GAP}|\b[Ss]upervis(?:or|ed by):?{_ONE_GAP})((?:{_FAMILY}{_ONE_GAP}){{1,3}}{_FAMILY})(?:(?:{_ONE_GAP}(?:and|or|und|et|y|ou|oder)|,){_ONE_GAP}((?:{_FAMILY}{_ONE_GAP}){{1,3}}{_FAMILY}))?")
_LAST_INITIAL = re.compile(rf"(?m)^[^\w\n]*(?:(?:Prof|Dr|Professor|Doctor)\.?[ ]+)*({_FAMILY}[ ]?,[ ]?[{_UP}]\.(?:[ ]?[{_UP}]\.)*)[ ]*\r?$")

_DOT = r"(?:\.|[ ]?(?:\[dot\]|\(dot\)|\{dot\})[ ]?|[ ]dot[ ])"
_EMAIL = re.compile(
    rf"""(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*(?:[ \u200b]{{0,2}}@[ \u200b]{{0,2}}|[ ]?(?:\[at\]|\(at\)|\{{at\}}|<at>)[ ]?)[\w-]+(?:{_DOT}[\w-]+)*?{_DOT}[A-Za-z]{{2,}}(?![\w-]|{_DOT}[A-Za-z]{{2,}})
    |(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*[ ]at[ ][\w-]+(?:(?:[ ]dot[ ]|\[dot\]|\(dot\))[\w-]*\w)+""",
    re.X | re.I,
)
_ID_LABEL = re.compile(
    r"""(?<![\w./-])(?:ssn|social\ security(?:\ (?:no|number|nr))?|passport(?:\ (?:no|number|nr|id))?|staff(?:\ (?:no|number|id|nr))|employee(?:\ (?:no|number|id|nr))|personnel(?:\ (?:no|number|id))
    |national\ (?:id|identity|insurance)(?:\ (?:no|number|card))?|identity\ card(?:\ (?:no|number))?|tax(?:payer)?(?:\ (?:no|number|id|nr|identification\ number))|id\ card(?:\ (?:no|number))?
    |personalnummer|steuer(?:nummer|-id)|sozialversicherungsnummer|ausweisnummer|reisepass(?:nummer)?|dni|nif|pasaporte|passeport|num[ée]ro\ de\ s[ée]curit[ée]\ sociale)
    (?:\.|\b)\s{0,2}(?:is\b|:|\#|no\b\.?|nr\b\.?|\s){0,4}[ ]?([A-Za-z]{0,3}-?\d(?:[\d/.-]*\d|[ ]\d{2}[ ]\d{4}|\d{2}[ ]\d{2}[ ]\d{4}){1,2}[A-Za-z]?)(?![\w])""",
    re.X | re.I,
)
_SSN = re.compile(r"(?<![\w/.-])\d{3}-\d{2}-\d{4}(?![\w/-])")
_PHONE = re.compile(
    r"""(?<![\w/.+-])(?:
      \+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ ]?)?\d{1,5}(?:[ .-]\d{2,6}){1,5}
    | 00[ ]\d{2,3}(?:[ ]\d{1,4}){2,5}
    | \(\d{3}\)[ ]?\d{3}[-. ]\d{4}
    | \d{3}\.\d{3}\.\d{4}
    | 1-\d{3}-\d{3}-\d{4}
    | 0\d{3,4}[ ]\d{3}[ ]?\d{3,4}
    | \d{3}[ -]\d{4}(?=[ ]?(?:x|ext\b\.?)[ ]?\d)
    )(?:[ ]?(?:x|ext\.?|extension)[ ]?\d{1,6})?(?![\w/-]|\.\d)""",
    re.X,
)
_LABELLED_PHONE = re.compile(r"(?i:\b(?:tel|phone|telephone|mobile|fax|office|call|t)\b[.:]?[ ]+)((?:\d{3}-)?\d{3}-\d{4}(?:[ ]?(?:x|ext\.?)[ ]?\d{1,6})?)(?![\w-])")
_TOWN = rf"[{_UP}][^\W\d_]+(?:[-'’][^\W\d_]+)*(?:[ ](?:am|sur|upon)[ ][{_UP}][^\W\d_]+)?"
_STREET = r"(?i:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Boulevard|Blvd|Close|Drive|Dr|Terrace|Way|Court|Ct|Place|Pl|Square|Sq|Crescent|Grove|Gardens|Row)\b\.?"
_NAMED = rf"[{_UP}][^\W\d_]+(?:[-'’ ][{_UP}][^\W\d_]+){{0,2}}"
_ADDRESS = re.compile(
    rf"""(?<![\w/.-])(?:
      (?:(?i:Flat|Apt|Apartment|Unit|Suite)\.?[ ]\d+\w?,[ ])?\d{{1,5}}\w?[ ]{_NAMED}[ ]{_STREET}(?:,[ ](?i:Flat|Apt)\.?[ ]\d+\w?)?,[ ]{_TOWN}(?:,?[ ]\d{{4,6}})?
    | \d{{1,4}}\w?,?[ ](?i:rue|avenue|boulevard|place|chemin|impasse|quai|all[ée]e)[ ](?:(?:de[ ]la|de|du|des)[ ])?{_NAMED},[ ](?:\d{{4,6}}[ ])?{_TOWN}
    | [{_UP}][^\W\d_]*(?i:straße|strasse|str\.|weg|platz|allee|gasse|ring|damm|ufer)[ ]\d{{1,4}}[a-z]?,[ ](?:\d{{4,6}}[ ])?{_TOWN}
    | (?i:Calle|Avenida|Avda\.|Plaza|Paseo|Camino)[ ](?:(?:de[ ]la|de|del)[ ])?{_NAMED},?[ ]\d{{1,4}},[ ](?:\d{{4,6}}[ ])?{_TOWN}
    | (?i:P\.?[ ]?O\.?[ ]Box|Postfach|Apartado|Bo[iî]te[ ]postale)[ ]\d+,[ ](?:\d{{4,6}}[ ]{_TOWN}|{_TOWN}(?:,?[ ]\d{{4,6}})?)
    )(?![\w])""",
    re.X,
)
_BORN = re.compile(r"(?i:\b(?:born|date of birth|dob|geboren|né|née|nacid[oa])\b[^\d\n]{0,12})(\d{1,2}[./-]\d{1,2}[./-]\d{4}|\d{4}-\d{2}-\d{2})")

_AUTOMATA: dict[frozenset, ahocorasick.Automaton] = {}


def _automaton(names: frozenset) -> ahocorasick.Automaton:
    found = _AUTOMATA.get(names)
    if found is None:
        found = ahocorasick.Automaton()
        for n in names:
            for form in {n, n.upper(), n.title()}:
                found.add_word(form, len(form))
        if not names:
            found.add_word("\0", 1)
        found.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[names] = found
    return found


def _family(word: str) -> bool:
    return word.lower() not in _NOT_FAMILY and len(word) > 1


def _thing_after(text: str, end: int) -> bool:
    m = re.compile(r"[ \xa0]+([A-Z]\w+)").match(text, end)
    return bool(m) and m.group(1).lower() in _THING


def _family_before(text: str, s: int) -> int | None:
    """Where the family name starts that stands before ``s`` with a comma, as in "Lee, Ann"."""
    j = s
    while j and text[j - 1] in " \xa0":
        j -= 1
    if not j or text[j - 1] != ",":
        return None
    j -= 1
    if j and text[j - 1] in " \xa0":
        j -= 1
    k = j
    while k and (text[k - 1].isalpha() or text[k - 1] in "-'’"):
        k -= 1
    return k if _ONE_FAMILY.fullmatch(text[k:j]) and _family(text[k:j]) and not (k and text[k - 1].isalnum()) else None


def own_given(name: str | None) -> list[str]:
    """Given names that the name of a page's person tells, as typed and in title case."""
    if not name:
        return []
    bare = re.sub(r"(?i)\b(?:assoc|asst|prof|professor|dr|doctor|mr|mrs|ms|ph\.?d|md|msc)\b\.?", " ", name)
    head, _, tail = bare.partition(",")
    found = [w for w in re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", tail if re.search(r"[^\W\d_]{2,}", tail) else head)]
    if tail.strip() and not re.search(r"[^\W\d_]{2,}", tail):
        found = found[:-1]
    words = found if re.search(r"[^\W\d_]{2,}", tail) else found[:-1]
    return sorted({f for w in words if len(w) > 2 and _family(w) for f in (w, w.title())})


def _occurrences(text: str, names: frozenset, own: list[str]) -> list[tuple[int, int]]:
    """(start, end) of each given name that stands as a word."""
    spans = [(last - size + 1, last + 1) for last, size in _automaton(names).iter(text)]
    for w in own:
        if w not in names:
            spans += [m.span() for m in re.finditer(re.escape(w), text)]
    out = []
    for s, e in sorted(spans, key=lambda x: (x[1], x[0])):
        if not ((s and (text[s - 1].isalnum() or text[s - 1] in "-_'’@.")) or (e < len(text) and (text[e].isalnum() or text[e] in "_@-'’"))):
            out.append((s, e))
    return out


def person_names(text: str, names: frozenset, own: list[str] | None = None) -> list[tuple[int, int]]:
    """Spans of given name or initials with a family name, in either order, and of names after a title or "contact".

    ``own`` are given names that only this text's person is known to bear.
    """
    spans: list[tuple[int, int]] = []
    done = -1
    known = names.union(own) if own else names
    for s, e in _occurrences(text, names, own or []):
        if s < done:
            continue
        m, given = _AFTER.match(text, e), e
        # further given names before the family name
        for _ in range(3):
            if not m:
                break
            if m.group(2) in known or m.group(2).title() in known:
                n = _AFTER.match(text, m.end())
                if not n or not _family(n.group(2)):
                    break
                m = n
            else:
                break
        if m and _family(m.group(2)) and not _thing_after(text, m.end()):
            if not (m.group(2) in known and _family_before(text, s) is not None):
                spans.append((s, m.end()))
                done = m.end()
                continue
        before = _family_before(text, s)
        if before is not None:
            more = re.compile(rf"(?:{_GAP}(?:{_FAMILY}))?").match(text, given)
            end = more.end() if more and more.group().strip() in known else given
            tail = _INITIALS_AFTER.match(text, end)
            spans.append((before, tail.end() if tail else end))
            done = spans[-1][1]
    for m in _INITIALS.finditer(text):
        if _family(m.group(2)) and not _thing_after(text, m.end()) and not m.group(1).startswith("P.O"):
            spans.append((m.start(), m.end()))
    for m in _LAST_INITIAL.finditer(text):
        spans.append(m.span(1))
    taken = sorted(spans)
    for m in _TITLED.finditer(text):
        for g in (1, 2):
            a, b = m.span(g)
            words = m.group(g).split() if a >= 0 else []
            if words and all(_family(w) and w.lower() not in _THING for w in words) and not _thing_after(text, b) and not any(x < b and a < y for x, y in taken):
                spans.append((a, b))
    return spans


def find(text: str | None, names: frozenset, own: list[str] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each item, in order, without overlaps.

    A number with a label counts as the label says; one without must be one that its
    numbering plan allows.
    """
    if not text:
        return []
    found: list[tuple[int, int, str]] = []
    low = None
    if "@" in text or "at]" in (low := text.lower()) or "at)" in low or " dot " in low or "[dot]" in low:
        for m in _EMAIL.finditer(text):
            item = m.group()
            if item[:4].lower() == "git@" or text[m.end() : m.end() + 1] == ":" and text[m.end() + 1 : m.end() + 2].isalnum():
                continue
            found.append((m.start(), m.end(), "email"))
    for m in _ID_LABEL.finditer(text):
        found.append((*m.span(1), "id_number"))
    for m in _SSN.finditer(text):
        if numbers.scheme(m.group()) is not None:
            found.append((*m.span(), "id_number"))
    for m in _ADDRESS.finditer(text):
        found.append((*m.span(), "address"))
    for m in _PHONE.finditer(text):
        if numbers.phone_plan(m.group()):
            found.append((*m.span(), "phone"))
    for m in _LABELLED_PHONE.finditer(text):
        found.append((*m.span(1), "phone"))
    for a, b in person_names(text, names, own):
        found.append((a, b, "person_name"))
    found.sort(key=lambda f: (KINDS.index(f[2]), f[0], -f[1]))
    kept: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []
    for a, b, kind in found:
        i = bisect.bisect_left(taken, (a, b))
        if (i and taken[i - 1][1] > a) or (i < len(taken) and taken[i][0] < b):
            continue
        taken.insert(i, (a, b))
        kept.append((a, b, kind))
    return sorted(kept)


# ---------------------------------------------------------------- placeholders


def placeholder(item: str, kind: str, key: bytes) -> str:
    """What stands for ``item`` in the redacted text.

    Telephone and identity numbers and dates that validate keep their format: digits are
    permuted, and the pseudonym validates too. All else gets a keyed tag of 128 bits,
    which links equal values.
    """
    new = None
    if kind == "phone":
        new = numbers.pseudonym_phone(item, key)
    elif kind == "id_number":
        new = numbers.pseudonym_id(item, key)
    elif kind == "birth_date":
        new = numbers.pseudonym_date(item, key)
    if new is not None:
        return f"[{kind.upper()}:{new}]"
    tag = hmac.new(key, f"{kind}:{' '.join(item.lower().split())}".encode(), hashlib.sha256).hexdigest()[:32]
    return f"[{kind.upper()}:{tag}]"


def personal(text: str | None, names: frozenset, own: list[str] | None = None) -> list[tuple[int, int, str]]:
    """The items of :func:`find` and dates of birth, in order."""
    items = find(text, names, own)
    for m in _BORN.finditer(text or ""):
        if not any(a < m.end(1) and m.start(1) < b for a, b, _ in items):
            items.append((*m.span(1), "birth_date"))
    return sorted(items)


def redacted_text(text: str | None, names: frozenset, key: bytes, own: list[str] | None = None) -> tuple[str | None, int]:
    """``text`` with each item replaced, all else as it was, and the number of items."""
    if not text:
        return text, 0
    items, out, at = personal(text, names, own), [], 0
    for a, b, kind in items:
        out += [text[at:a], placeholder(text[a:b], kind, key)]
        at = b
    return "".join([*out, text[at:]]), len(items)


def redact(text: str | None, names: frozenset, key: bytes) -> str | None:
    """``text`` with each item replaced."""
    return redacted_text(text, names, key)[0]


_PLACEHOLDER = re.compile(r"\[(" + "|".join(k.upper() for k in (*KINDS, "birth_date")) + r"):([^\]]*)\]")


def restored_text(text: str | None, key: bytes, tags: dict[str, str]) -> str | None:
    """The text that :func:`redacted_text` was given: pseudonyms are undone with the key, tags looked up."""
    if not text:
        return text

    def undo(m: re.Match) -> str:
        kind, value = m.group(1).lower(), m.group(2)
        if m.group() in tags:
            return tags[m.group()]
        back = {"phone": numbers.pseudonym_phone, "id_number": numbers.pseudonym_id, "birth_date": numbers.pseudonym_date}.get(kind)
        return m.group() if back is None else back(value, key, undo=True) or m.group()

    return _PLACEHOLDER.sub(undo, text)


# ---------------------------------------------------------------- tables


def learnt(profiles: DataFrame, name: str = "profile_name", least: int = LEARN_FROM) -> DataFrame:
    """(first) given names that profile names tell: words before ``least`` different last words, seldom last themselves."""
    bare = F.regexp_replace(F.regexp_replace(name, r"(?i)\b(?:assoc|asst|prof|professor|dr|doctor|mr|mrs|ms)\b\.?", " "), r",.*$", "")
    parts = F.split(F.trim(F.regexp_replace(bare, r"\s+", " ")), " ")
    pairs = profiles.where(F.col(name).isNotNull() & ~F.col(name).contains(",")).select(F.element_at(parts, 1).alias("first"), F.element_at(parts, -1).alias("last")).where("size(split(first, '')) > 2 and first <> last").distinct()
    firsts = pairs.where(r"first rlike '^\\p{Lu}\\p{L}*[\\p{Ll}][\\p{L}-]*$'").groupBy("first").agg(F.count("*").alias("n"))
    lasts = pairs.groupBy(F.col("last").alias("first")).agg(F.count("*").alias("m"))
    return firsts.where(F.col("n") >= least).join(lasts, "first", "left").where(F.col("n") >= FIRST_TO_LAST * F.coalesce("m", F.lit(0))).select("first")


def _fit(rows) -> frozenset:
    return frozenset(GIVEN) | {r.first for r in rows if r.first.lower() not in _NOT_FAMILY}


def learnt_names(profiles: DataFrame, name: str = "profile_name", least: int = LEARN_FROM) -> frozenset:
    """Given names: the fixed list and those learnt."""
    return _fit(learnt(profiles, name, least).collect())


def _named(pages: DataFrame, profiles: DataFrame | None, *columns: str) -> tuple[DataFrame, Callable]:
    """``pages`` with a column ``_names``, and a function from its value to the given names to look for."""
    chosen = pages.select("id", "raw_text", (F.col("profile_name") if "profile_name" in pages.columns else F.lit(None)).cast("string").alias("profile_name")).where("id is not null")
    names = stored(learnt(profiles), "p4-names") if profiles is not None else None
    if names is None or names.count() <= MAX_LEARNT:
        shared = pages.sparkSession.sparkContext.broadcast(frozenset(GIVEN) if names is None else _fit(names.collect()))  # at most MAX_LEARNT
        return chosen.withColumn("_names", F.lit(None).cast("array<string>")), lambda _: shared.value
    words = chosen.select("id", F.explode(F.array_distinct(F.regexp_extract_all("raw_text", F.lit(r"(\p{Lu}[\p{L}-]+)"), 1))).alias("w"))
    forms = words.select("id", F.explode(F.array_distinct(F.array("w", F.initcap("w")))).alias("first"))
    mine = sized_semi_join(forms, names, ["first"]).groupBy("id").agg(F.collect_set("first").alias("_names"))
    return chosen.join(mine, "id", "left"), lambda value: frozenset(GIVEN) | {w for w in (value if value is not None else ()) if w.lower() not in _NOT_FAMILY}


def found_items(pages: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """(id, pii_kind, pii_text) of each different item of each text."""
    columns, names_of = _named(pages, profiles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, name, known in zip(batch["id"], batch["raw_text"], batch["profile_name"], batch["_names"], strict=True):
                rows.extend((key, kind, item) for kind, item in {(kind, text[a:b]) for a, b, kind in find(text, names_of(known), own_given(name))})
            yield pd.DataFrame(rows, columns=["id", "pii_kind", "pii_text"])

    return spread(columns.where("raw_text is not null")).mapInPandas(run, "id string, pii_kind string, pii_text string").distinct()


def redacted(pages: DataFrame, key: str, profiles: DataFrame | None = None) -> DataFrame:
    """(id, raw_text, items) of each record once, with placeholders under the caller's key; ``items`` counts them."""
    secret = _secret(key)
    columns, names_of = _named(one_per_key(pages, "id"), profiles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [redacted_text(t, names_of(k), secret, own_given(n)) for t, k, n in zip(batch["raw_text"], batch["_names"], batch["profile_name"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "raw_text": [r[0] for r in done], "items": [r[1] for r in done]})

    return spread(columns).mapInPandas(run, "id string, raw_text string, items int")


def restored(redacted_pages: DataFrame, pages: DataFrame, key: str, profiles: DataFrame | None = None) -> DataFrame:
    """(id, raw_text): the texts before redaction, for whoever holds the key and the table of tags.

    That table is made here from the items of the pages, by page, so nothing is held for
    all pages at once.
    """
    secret = _secret(key)
    columns, names_of = _named(one_per_key(pages, "id"), profiles)

    def tags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, k, n in zip(batch["raw_text"], batch["_names"], batch["profile_name"], strict=True):
                table = {placeholder(t[a:b], kind, secret): t[a:b] for a, b, kind in personal(t, names_of(k), own_given(n))} if t else {}
                out.append(sorted(x for x in table.items() if re.search(r":[0-9a-f]{32}\]$", x[0])))
            yield pd.DataFrame({"id": batch["id"], "tags": [[{"tag": a, "item": b} for a, b in x] for x in out]})

    def undo(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            back = [restored_text(t, secret, {x["tag"]: x["item"] for x in (g if g is not None else ())}) for t, g in zip(batch["raw_text"], batch["tags"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "raw_text": back})

    known = columns.mapInPandas(tags, "id string, tags array<struct<tag:string,item:string>>")
    return redacted_pages.select("id", "raw_text").join(known, "id", "left").mapInPandas(undo, "id string, raw_text string")


def _secret(key: str) -> bytes:
    if not key:
        raise ValueError("redaction needs a key")
    return key.encode()
