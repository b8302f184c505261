"""Column expressions on names of persons and on what speaks of them. All stay in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import links as L
from lectern.functions import urls as U
from lectern.functions.text import collapsed, distinct_by, let


def _accents() -> tuple[str, str]:
    """Latin letters with marks and what they are without, by Unicode's decompositions."""
    pairs = [(chr(c), "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))) for c in range(0xC0, 0x250)]
    kept = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in kept), "".join(b for _, b in kept)


_FROM, _TO = _accents()
# Fixed values.
TITLES = ["Dr.", "Dr", "Professor", "Prof."]
SUFFIXES = "jr sr ii iii iv phd md do".split()
NOT_NEAR = "dr mr mrs ms prof professor assistant associate adjunct emeritus former faculty deceased department program school college university of the and cv resume vitae pdf doc docx page profile team people person staff directory news group lab research about".split()
BANNED = "academic african american center college department foundation history institute interview museum news part professor resource school society supplies university www".split()
NOT_PERSON = "program office department school center centre committee services".split()
KEEP_ROLE = "professor|lecturer|instructor|faculty|dean|chair|director|endowed"
DROP_ROLE = "phd student|phd candidate|ph.d. student|ph.d. candidate|doctoral student|doctoral candidate|graduate research associate|graduate research assistant|graduate teaching associate|graduate teaching assistant|graduate assistant|graduate associate|graduate fellow|masters student|master student|visiting fellow|visiting scholar|postdoctoral|post-doctoral|postdoc |research assistant|clinical research assistant".split("|")
ROLE_IN = r"\b(?:assistant|associate|adjunct|clinical|visiting|research|distinguished|emeritus|teaching|full|endowed)?\s*professor(?:\s+of\s+practice)?\b|\bscholar\b"
ROLE_OUT = r"\b(?:staff|student|undergraduate|graduate|phd candidate|doctoral candidate|postdoc|postdoctoral|administrator|coordinator|manager|specialist|technician)\b"


def without_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, _FROM, _TO), r"\p{Mn}", "")


def ascii_only(text: Column) -> Column:
    """Text without accents, control characters as blanks, and nothing beyond ASCII."""
    return F.regexp_replace(F.regexp_replace(without_accents(text), r"[^\x00-\x7F]", ""), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")


def normalized(name: Column) -> Column:
    """Lower case without accents and punctuation, single blanks; "" for null."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(without_accents(F.coalesce(name, F.lit("")))), "[.,;:'\"()-]", " "), r"[\s\x{A0}]+", " "))


def _word(text: Column, n: int) -> Column:
    return F.coalesce(F.try_element_at(F.filter(F.split(text, " "), lambda w: w != ""), F.lit(n)), F.lit(""))


def first_last(name: Column) -> Column:
    """(first, last) of "First Last" or "Last, First"; one word is a first name."""
    head, tail = F.split_part(name, F.lit(","), F.lit(1)), F.regexp_extract(name, r"^[^,]*,(.*)$", 1)
    plain = normalized(name)
    one = F.size(F.filter(F.split(plain, " "), lambda w: w != "")) < 2
    comma = F.coalesce(name.contains(","), F.lit(False))
    return F.struct(F.when(comma, _word(normalized(tail), 1)).otherwise(_word(plain, 1)).alias("first"), F.when(comma, _word(normalized(head), -1)).when(one, "").otherwise(_word(plain, -1)).alias("last"))


def _firsts_agree(a: Column, b: Column) -> Column:
    return (a != "") & (b != "") & (a.startswith(b) | b.startswith(a))


def names_match(first: Column, last: Column, found: Column, need_first: bool = True) -> Column:
    """Whether a found name may be the person's: the same last name, and first names of which one starts the other."""
    q_first, q_last, f = normalized(first), normalized(last), first_last(found)
    same = (q_last != "") & (f["last"] != "") & (q_last == f["last"])
    return F.coalesce(same & _firsts_agree(q_first, f["first"]) if need_first else same, F.lit(False))


def names_match_loosely(first: Column, last: Column, found: Column) -> Column:
    """Like :func:`names_match`, with double names written together, suffixes dropped, and a missing first name let pass."""
    q_first, q_last, f = normalized(first), normalized(last), first_last(F.replace(found, F.lit(","), F.lit(", ")))
    bare = lambda c: _word(F.array_join(F.filter(F.split(c, " "), lambda w: ~w.isin(SUFFIXES)), " "), 1)
    a, b = F.coalesce(F.nullif(bare(q_first), F.lit("")), q_first), F.coalesce(F.nullif(bare(f["first"]), F.lit("")), f["first"])
    same = (q_last != "") & (f["last"] != "") & (F.replace(q_last, F.lit(" "), F.lit("")) == f["last"])
    return F.coalesce(same & ((q_first == "") | (f["first"] == "") | _firsts_agree(a, b)), F.lit(False))


def affiliated(text: Column, home: str) -> Column:
    """Whether a text names the institution."""
    return F.coalesce(F.lower(text).contains(home.lower()), F.lit(False))


def matches_person(first: Column, last: Column, found: Column, affiliations: Column, home: str, need_home: bool = False) -> Column:
    """Name, and where asked for and told, an affiliation of the institution."""
    at_home = F.exists(affiliations, lambda a: affiliated(a, home))
    ok = names_match(first, last, found)
    return F.coalesce(ok & ((F.coalesce(F.size(affiliations), F.lit(0)) <= 0) | F.coalesce(at_home, F.lit(False))) if need_home else ok, F.lit(False))


def mentions(texts: Sequence[Column], name: Column, first: Column, last: Column, need_first: bool = True) -> Column:
    """Whether an article's fields name the person: the full name, first and last name, or the last alone if that is enough."""
    blob = F.concat_ws(" ", *[normalized(t) for t in texts])
    hit = blob.contains(normalized(name)) | (blob.contains(normalized(first)) & blob.contains(normalized(last)))
    return F.coalesce(hit if need_first else hit | blob.contains(normalized(last)), F.lit(False))


def strict_identity(text: Column, first: Column, last: Column, home: str, department: Column | None = None, least: int = 1) -> Column:
    """Whether a text belongs to this person: full name or initial with last name, said often enough, and the institution or department."""
    t, f, la = normalized(text), normalized(first), normalized(last)
    count = lambda x: (F.length(t) - F.length(F.replace(t, x, F.lit("")))) / F.greatest(F.length(x), F.lit(1))
    often = count(F.concat(F.lit(" "), la, F.lit(" "))) + count(F.concat(la, F.lit(" "))) + F.when(t.startswith(F.concat(la, F.lit(" "))), 1).otherwise(0)
    i = F.substring(f, 1, 1)
    pair = lambda a, b: t.contains(F.concat_ws(" ", a, b))
    middle = F.regexp_like(t, F.concat(F.lit(r"\Q"), f, F.lit(r"\E [a-z] \Q"), la, F.lit(r"\E")))
    named = pair(f, la) | pair(la, f) | (f == "") | pair(i, la) | pair(la, i) | middle
    dept = F.lit(False) if department is None else (F.length(normalized(department)) >= 3) & t.contains(normalized(department))
    at_home = t.contains(home.lower()) | F.coalesce(dept, F.lit(False))
    return F.coalesce((F.coalesce(text, F.lit("")) != "") & (la != "") & (often >= least) & named & at_home, F.lit(False))


def name_parts(name: Column) -> Column:
    """(title, first, middle, last) of a full name."""
    title = F.lit("")
    for t in reversed(TITLES):
        title = F.when(name.startswith(t), t).otherwise(title)
    rest = F.when(title == "", name).otherwise(F.trim(F.replace(name, title, F.lit(""))))
    w = F.filter(F.split(F.trim(rest), r"[\s\x{A0}]+"), lambda x: x != "")
    n = F.size(w)
    return F.struct(
        title.alias("title"), F.coalesce(F.try_element_at(w, F.lit(1)), F.lit("")).alias("first"), F.when(n > 2, F.array_join(F.slice(w, 2, F.greatest(n - 2, F.lit(0))), " ")).otherwise("").alias("middle"),
        F.when(n > 1, F.try_element_at(w, F.lit(-1))).otherwise("").alias("last"),
    )


def monogram(first: Column, last: Column) -> Column:
    """The letter that stands for a person without portrait."""
    return F.when(first != "", F.upper(F.substring(first, 1, 1))).when(last != "", F.upper(F.substring(last, 1, 1))).otherwise("?")


def identity_parts(name: Column) -> Column:
    """(whole, first, last, variants): the name in lower case, its ends, and how it may be written."""
    whole = F.trim(F.regexp_replace(F.replace(F.lower(name), F.lit("."), F.lit(" ")), r"\s+", " "))
    p = F.regexp_extract_all(whole, F.lit("([a-z0-9]+)"), 1)
    first = F.coalesce(F.try_element_at(p, F.lit(1)), F.lit(""))
    last = F.when(F.size(p) >= 2, F.try_element_at(p, F.lit(-1))).otherwise("")
    initials = F.array_join(F.concat(F.transform(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda x: F.substring(x, 1, 1)), F.array(last)), " ")
    both = (first != "") & (last != "")
    made = F.array(whole, F.array_join(p, " "), F.when(both, F.concat_ws(" ", first, last)), F.when(both, initials))
    return F.struct(whole.alias("whole"), first.alias("first"), last.alias("last"), F.filter(F.array_distinct(made), lambda v: v.isNotNull() & (v != "")).alias("variants"))


def name_variants(name: Column) -> Column:
    """A name as typed, without full stops, with single blanks, and with the initial alone; each once, case aside."""
    raw = F.trim(name)
    plain = F.replace(raw, F.lit("."), F.lit(""))
    one = F.trim(F.regexp_replace(plain, r"\s+", " "))
    w = F.filter(F.split(one, " "), lambda x: x != "")
    first, last = F.try_element_at(w, F.lit(1)), F.try_element_at(w, F.lit(-1))
    short = F.when((F.size(w) >= 2) & (F.length(first) <= 2) & first.rlike(r"^\p{L}+$"), F.concat_ws(" ", F.substring(first, 1, 1), last))
    made = F.filter(F.array(raw, plain, one, short), lambda v: v.isNotNull() & (v != ""))
    return F.when(F.coalesce(raw, F.lit("")) == "", F.array().cast("array<string>")).otherwise(distinct_by(made, F.lower))


def conflicts(text: Column, first: Column, last: Column, reach: int = 2, ignored: Sequence[str] = tuple(NOT_NEAR)) -> Column:
    """Whether the last name stands beside another first name: some mention has neither the first name nor its initial within ``reach`` words, but another word."""
    def check(t: Column) -> Column:
        near = lambda i: F.filter(F.array(*[F.when(i + o >= 1, F.try_element_at(t, F.greatest(i + o, F.lit(1)))) for o in range(-reach, reach + 1) if o]), lambda w: w.isNotNull())
        mine = lambda w: (w == first) | ((F.length(w) <= 2) & (F.substring(w, 1, 1) == F.substring(first, 1, 1)))
        bad = lambda n: ~F.exists(n, mine) & F.exists(n, lambda w: (F.length(w) >= 3) & ~w.isin(list(ignored)))
        at = F.filter(F.transform(t, lambda w, i: F.when(w == last, (i + 1).cast("int"))), lambda i: i.isNotNull())
        return F.exists(F.transform(at, near), bad)

    return F.coalesce((first != "") & (last != "") & let(F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), 1), check), F.lit(False))


def tells_person(text: Column, who: Column) -> Column:
    """Whether a title or address tells the person (:func:`identity_parts`) by any way of writing the name."""
    low = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[_/-]+", " "), r"\s+", " "))
    tight = lambda v: F.regexp_replace(v, "[^a-z0-9]+", "")

    def check(x: Column) -> Column:
        hit = F.exists(who["variants"], lambda v: x["low"].contains(v) | ((tight(v) != "") & x["tight"].contains(tight(v))))
        return hit | ((who["first"] != "") & (who["last"] != "") & x["low"].contains(who["first"]) & x["low"].contains(who["last"]))

    return F.coalesce(let(F.struct(low.alias("low"), tight(low).alias("tight")), check), F.lit(False))


def front_matter(text: Column, who: Column, within: int = 30) -> Column:
    """Whether a document names the person within its first characters."""
    return F.coalesce(let(F.lower(collapsed(text)), lambda low: F.exists(who["variants"], lambda v: F.position(v, low).between(1, within + 1))), F.lit(False))


def relevant(text: Column, name: Column) -> Column:
    """Whether a text names the person: as typed, without full stops, first before last, or initials with last name."""
    t, n = F.lower(collapsed(text)), F.lower(collapsed(name))
    bare = F.trim(F.regexp_replace(F.replace(n, F.lit("."), F.lit(" ")), r"\s+", " "))
    p = F.filter(F.regexp_extract_all(n, F.lit("([a-z0-9]+)"), 1), lambda w: F.length(w) >= 2)
    first, last = F.try_element_at(p, F.lit(1)), F.try_element_at(p, F.lit(-1))
    inits = F.array_join(F.concat(F.transform(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda x: F.substring(x, 1, 1)), F.array(last)), " ")
    ordered = F.regexp_like(t, F.concat(F.lit(r"\b"), first, F.lit(r"\b.*\b"), last, F.lit(r"\b")))
    more = (F.size(p) >= 2) & (F.coalesce(ordered, F.lit(False)) | F.coalesce(t.contains(inits), F.lit(False)))
    return F.coalesce((t != "") & ((n == "") | t.contains(n) | ((bare != "") & t.contains(bare)) | more), name.isNull() & text.isNotNull())


def occurrences(text: Column, part: Column) -> Column:
    """How often ``part`` stands in a text, without overlaps; 0 for an empty part."""
    n = ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.nullif(F.length(part), F.lit(0))).cast("int")
    return F.coalesce(n, F.lit(0))


def about_person(text: Column, name: Column, long: int = 4000, per: int = 2500) -> Column:
    """Whether a page is about the person: named in full, twice by last name, or by both ends; long pages must name the person in proportion."""
    t, n = F.lower(text), F.trim(F.lower(name))
    p = F.filter(F.split(n, r"\s+"), lambda w: F.length(w) >= 3)
    first, last = F.try_element_at(p, F.lit(1)), F.try_element_at(p, F.lit(-1))
    times, full = occurrences(t, last), (n != "") & t.contains(n)
    inits = F.concat(F.array_join(F.transform(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda x: F.substring(x, 1, 1)), "."), F.lit("."))
    basic = full | (times >= 2) | ((times >= 1) & t.contains(first)) | ((F.size(p) > 1) & t.contains(inits) & (times >= 1))
    words = F.regexp_count(t, F.lit(r"\w+"))
    dense = (words <= long) | full | (times >= F.greatest(F.lit(2), F.floor(words / per)))
    return F.when((F.coalesce(text, F.lit("")) == "") | (F.coalesce(name, F.lit("")) == "") | (F.size(p) <= 0), True).otherwise(F.coalesce(basic & dense, F.lit(False)))


def source_fits(kind: Column, url: Column, label: Column, text: Column, name: Column) -> Column:
    """Whether a source is about the person, by the rules for its kind.

    No title or address may tell another person; documents must name the person early
    and in title, address or front matter; listings in title or address or twice by last
    name; other pages as :func:`about_person` says.
    """
    who = identity_parts(name)
    lead = F.substring(text, 1, 4000)
    in_lead = relevant(lead, name)
    by_title, by_url = tells_person(label, who), tells_person(url, who)
    clash = conflicts(label, who["first"], who["last"]) | conflicts(url, who["first"], who["last"])
    document = in_lead & (by_url | by_title | front_matter(F.substring(lead, 1, 1400), who))
    listing = in_lead & (by_title | by_url | ((who["last"] != "") & (occurrences(F.lower(text), who["last"]) >= 2)))
    fits = F.when((kind == "cv") | L.document_like(url), document).when(L.generic_listing(url), listing).otherwise(about_person(text, name))
    return F.when(F.coalesce(name, F.lit("")) == "", True).otherwise((F.coalesce(text, F.lit("")) != "") & ~clash & F.coalesce(fits, F.lit(False)))


def result_fits(url: Column, title: Column, snippet: Column, name: Column, first: Column, last: Column, field: Column, department: Column, home: str, home_words: Sequence[str]) -> Column:
    """Whether a search result is about the person: the name in text or address, and an authority for it.

    A last name of three letters never counts alone; one of five may, in an address.
    Authorities are the institution's hosts and name, scholarly indexes, academic and
    public hosts, and the person's field or department.
    """
    blob, u = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(snippet, F.lit("")))), F.lower(F.coalesce(url, F.lit("")))
    n, f, la = F.lower(name), F.lower(first), F.lower(last)
    tight = F.regexp_replace(u, "[^a-z0-9]+", "")
    long = F.length(la) > 3
    in_text = blob.contains(n) | (blob.contains(la) & (((f != "") & blob.contains(f)) | long))
    slug = F.regexp_replace(n, "[^a-z0-9]+", "")
    in_url = ((slug != "") & tight.contains(slug)) | ((f != "") & (u.contains(f) | tight.contains(f)) & (u.contains(la) | tight.contains(la))) | ((F.length(la) >= 5) & tight.contains(la))
    host = U.host(url)
    padded = F.concat(F.lit(" "), blob, F.lit(" "))
    told = L.under(host, [home]) | L.any_of(padded, list(home_words)) | L.under(host, L.PRIORITY[: L.AUTHORITIES]) | host.rlike(r"\.(?:edu|gov)$")
    subject = ((F.lower(field) != "") & blob.contains(F.lower(field))) | ((F.lower(department) != "") & blob.contains(F.lower(department)))
    return F.when((n == "") | (la == ""), True).otherwise(F.coalesce((in_text | in_url) & (F.coalesce(told, F.lit(False)) | F.coalesce(subject, F.lit(False))), F.lit(False)))


def author_score(display: Column, institutions: Column, works: Column, orcid: Column, name: Column, first: Column, last: Column, home: Column) -> Column:
    """Points for an author record: 100 for the name, 30 for both ends of it, 15 for each shared word of the institution (five at most), 10 for an identifier, one for twenty works (ten at most)."""
    d = F.lower(display)
    words = lambda c: F.array_distinct(F.filter(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), 1), lambda w: (F.length(w) > 2) & ~w.isin("the", "and", "university", "college", "institute")))
    shared = F.coalesce(F.array_max(F.transform(institutions, lambda i: F.size(F.array_intersect(words(i), words(home))))), F.lit(0))
    ends = (first != "") & (last != "") & d.contains(F.lower(first)) & d.contains(F.lower(last))
    return (
        F.when((normalized(display) != "") & (normalized(display) == normalized(name)), 100).otherwise(0) + F.when(F.coalesce(ends, F.lit(False)), 30).otherwise(0) + F.least(shared, F.lit(5)) * 15
        + F.when(F.coalesce(orcid, F.lit("")) != "", 10).otherwise(0) + F.floor(F.least(F.coalesce(works, F.lit(0)), F.lit(200)) / 20).cast("int")
    )


def in_authors(authors: Column, first: Column, last: Column) -> Column:
    """Whether a list of authors, as one text, has the last name and the first three letters of the first."""
    a, f, la = normalized(authors), normalized(first), normalized(last)
    return F.coalesce((la != "") & a.contains(la) & ((f == "") | a.contains(F.substring(f, 1, 3))), F.lit(False))


def author_among(authors: Column, last: Column) -> Column:
    """Whether any author of an array has the last name."""
    la = normalized(last)
    return F.coalesce(F.exists(authors, lambda a: (la != "") & (first_last(a)["last"] == la)), F.lit(False))


def looks_like_id(text: Column) -> Column:
    """Whether a label is only a number, a long hexadecimal string or the tail of an identifier; true for an empty one."""
    v = F.trim(F.coalesce(text, F.lit("")))
    tight = F.regexp_replace(v, "[ _.-]", "")
    return (v == "") | v.rlike("^[0-9]+$") | (tight.rlike("^[A-Fa-f0-9]{8,}$") & (F.length(tight) >= 16)) | v.rlike(r"^[0-9]{4,}(?:[._-][0-9A-Za-z]+)*$")


def clean_name(text: Column) -> Column:
    """Whether a label is a person's name: two to five words, two of them capitalised, nothing of addresses or institutions."""
    v = F.trim(F.coalesce(text, F.lit("")))
    w = F.regexp_extract_all(v, F.lit("([A-Za-z][A-Za-z.'-]*)"), 1)
    bad = F.lower(v).rlike(r"https?://|\.com|\.org|\.edu") | v.rlike(r"[;|/\\]| - ") | F.exists(w, lambda x: F.regexp_replace(F.lower(x), r"^\.+|\.+$", "").isin(BANNED))
    return F.size(w).between(2, 5) & ~bad & (F.size(F.filter(w, lambda x: x.rlike("^[A-Z]"))) >= 2)


def person_words(text: Column) -> Column:
    """Whether a label has two words and none that only offices have."""
    w = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([A-Za-z]+)"), 1)
    return (F.size(w) >= 2) & ~F.exists(w, lambda x: F.lower(x).isin(NOT_PERSON))


def role(text: Column) -> Column:
    """(include, reason): a target role wins over others; without either the person is left out."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hit, miss = collapsed(F.regexp_extract(low, f"({ROLE_IN})", 1)), collapsed(F.regexp_extract(low, f"({ROLE_OUT})", 1))
    reason = F.when(hit != "", F.concat(F.lit("matched_role:"), hit)).when(miss != "", F.concat(F.lit("non_target_role:"), miss)).otherwise("no_professor_or_scholar_title_detected")
    return F.struct((hit != "").alias("include"), reason.alias("reason"))


def professor_level(expertise: Column) -> Column:
    """Whether a position is a professor's: kept titles win, students and assistants are out (but not "research assistant professor"), the untold stay."""
    e = F.lower(F.coalesce(expertise, F.lit("")))
    others = L.any_of(e, [d for d in DROP_ROLE if d != "research assistant"])
    assistant = e.contains("research assistant") & ~e.contains("research assistant professor")
    return (e == "") | e.rlike(KEEP_ROLE) | ~(others | assistant)


def department_of(text: Column) -> Column:
    """The department that the head of a page names: after the word itself, or after a position and comma."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, 500)
    named = F.trim(F.regexp_extract(head, r"(?:[Dd]epartment|[Dd]ept\.?)\s+(?:of\s+)?([A-Z][A-Za-z\s&,]+?)(?:\n|\.|\|)", 1))
    after = r"(?:Professor|Associate Professor|Assistant Professor|Instructor|Lecturer|Research (?:Associate|Scientist|Fellow)|Fellow|Graduate (?:Research|Teaching) (?:Associate|Assistant)|Visiting (?:Scholar|Fellow|Professor|Assistant Professor)),?\s+([A-Z][A-Za-z\s&,]+?)(?:\n|\.|$)"
    role_named = F.regexp_replace(F.trim(F.regexp_extract(head, after, 1)), "[, ]+$", "")
    return F.when(named != "", named).otherwise(role_named)


def first_int(text: Column, default: int = 0) -> Column:
    """The first run of digits as a number."""
    return F.coalesce(F.regexp_extract(F.coalesce(text.cast("string"), F.lit("")), r"([0-9]+)", 1).try_cast("int"), F.lit(default))


def money(text: Column) -> Column:
    """An amount with a currency sign, commas and cents as a number; null if there is none."""
    return F.regexp_replace(F.regexp_extract(text, r"[$€£]\s*([0-9][0-9,]*(?:\.[0-9]+)?)", 1), ",", "").try_cast("double")


def years(text: Column) -> Column:
    """The years from 1900 to 2099 of a text, sorted, each once."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?=[^0-9]|$)"), 1), lambda y: y.cast("int"))))


def keywords(parts: Column, most: int = 20) -> Column:
    """The first ``most`` different entries, trimmed, case aside, blank ones dropped."""
    plain = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")
    return F.slice(distinct_by(plain, F.lower), 1, most)
