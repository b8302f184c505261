"""Names of persons and institutions as people type them, in a comparable form."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Given names.
GIVEN = """Abigail Agnes Aiko Alexander Amara Anders Andrew Anna Anne Anne-Marie Anneke Barbara Beatriz Benjamin Bruno Celia Charles Chloé Christopher
Cyril Dagmar Daniel Dario David Deborah Dorothy Edward Eleanor Elena Elif Elizabeth Emily Emma Eric Esteban Eugene Farid Fatima Femke Francesca François
Frederick Gerald Goran Gregory Greta Hana Hans Helga Hugo Ilse Imani Ines Ingrid Isabella Ivana James Jana Jean Jean-Luc Jennifer John Jonathan Jorge
José Joseph Josephine Julia Jürgen Karim Katherine Katya Kofi Lars Laura Lawrence Leila Linda Lucia Luis Marek Margaret Maria Marie Mark Martin Mary
Mary-Beth Matthew Mei Michael Milan Mira Mohammed Nadia Nicholas Nikhil Noor Olga Omar Paolo Patricia Paul Pavel Peter Philippa Pierre Piotr Priya
Quentin Ravi Rebecca Renée Richard Robert Rosa Samantha Sanjay Sarah Soo-jin Sofia Stefan Steven Susan Søren Tariq Tessa Thandi Theodore Thomas Timothy
Tomas Ulrich Vera Victoria Wanda Wei William Xavier Yara Yuki Zainab Zoltan Zoë""".split()

# Short forms of given names.
NICKNAMES = {
    short: full
    for full, shorts in {
        "abigail": "abby aby abbie gail",
        "alexander": "alex sasha sandy xander",
        "andrew": "andy drew",
        "anthony": "tony",
        "barbara": "barb babs bab",
        "benjamin": "ben benny",
        "charles": "charlie chuck chas",
        "christopher": "chris kit topher",
        "daniel": "dan danny",
        "david": "dave davey",
        "deborah": "deb debbie debby",
        "dorothy": "dot dottie dolly",
        "edward": "ed eddie ned ted",
        "eleanor": "ellie nell nora",
        "elizabeth": "liz beth lizzie betty eliza libby",
        "eugene": "gene",
        "francesca": "fran franny cesca",
        "frederick": "fred freddie freddy",
        "gerald": "gerry jerry",
        "gregory": "greg",
        "isabella": "izzy bella isa",
        "james": "jim jimmy jamie",
        "jennifer": "jen jenny jenn",
        "john": "jack johnny",
        "jonathan": "jon jonny",
        "joseph": "joe joey",
        "josephine": "jo josie",
        "katherine": "kate kathy katie kat kathie",
        "lawrence": "larry",
        "margaret": "maggie meg peggy marge",
        "matthew": "matt matty",
        "michael": "mike mick mickey",
        "nicholas": "nick nicky",
        "patricia": "pat patty trish tricia",
        "philippa": "pippa pip",
        "rebecca": "becky becca",
        "richard": "rich rick dick ricky",
        "robert": "rob bob bobby robbie",
        "samantha": "sam sammy",
        "stephen": "steph",
        "steven": "steve stevie",
        "susan": "sue susie suzy",
        "theodore": "theo teddy",
        "thomas": "tom tommy",
        "timothy": "tim timmy",
        "victoria": "vicky vickie tori vic",
        "william": "will bill billy liam",
    }.items()
    for short in shorts.split()
}

# What stands around a name.
_AROUND = frozenset("prof professor dr doctor assoc associate asst assistant mr mrs ms phd md faas jr sr ii iii iv msc bsc ma mba dphil emeritus ing habil ph d m".split()) - {"d", "m"}
_TITLES = re.compile(
    r"\b(?:assoc(?:iate)?|asst|assistant|adjunct|prof(?:essor)?|dr|doctor|mr|mrs|ms)\b\.?|\b(?:ph\.?\s?d|m\.d|md|faas|esq|jr|sr|iii|ii|iv|m\.?sc|b\.?sc|mba|d\.?phil|emerit(?:us|a))\b\.?",
    re.I,
)
_DIGITS = str.maketrans("0135", "oles")
_SPECIAL = str.maketrans({"ø": "o", "Ø": "O", "ß": "ss", "æ": "ae", "œ": "oe", "ł": "l", "đ": "d", "ı": "i"})


@lru_cache(maxsize=200_000)
def plain(s: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", s.translate(_SPECIAL)) if not unicodedata.combining(c)).lower()


_GIVEN = frozenset(plain(n) for n in GIVEN) | frozenset(NICKNAMES) | frozenset(NICKNAMES.values())


@lru_cache(maxsize=200_000)
def canonical(given: str) -> str:
    """The full form of a given name."""
    return NICKNAMES.get(given, given)


def parse(name: str | None) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(given names and initials, family names) of a typed name, folded.

    Family names come in the order typed, hyphened ones apart. Either part may be empty.
    """
    if not name:
        return (), ()
    s = unicodedata.normalize("NFC", name.replace("\xa0", " ")).strip()
    s = re.sub(r"(?<=[^\W\d_])[0135](?=[^\W\d_])|(?<=[^\W\d_])[01](?=\b)", lambda m: m.group().translate(_DIGITS), s)
    s = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ])", " ", s) if not s.isupper() else s
    s = _TITLES.sub(" ", s)
    parts = [p.strip(" .") for p in s.split(",")]
    parts = [p for p in parts if re.search(r"[^\W\d_]", p)]
    if not parts:
        return (), ()

    def tokens(p: str) -> list[str]:
        out = []
        for w in re.findall(r"[^\W\d_]+(?:['’\-‐‑][^\W\d_]+)*\.?", p):
            bare = w.rstrip(".")
            if len(bare) == 2 and bare.isupper() and plain(bare) not in _GIVEN:
                out.extend(plain(c) for c in bare)
            else:
                out.append(plain(bare).replace("’", "").replace("'", ""))
        return out

    if len(parts) > 1:
        family, given = tokens(parts[0]), tokens(" ".join(parts[1:]))
        if family and given:
            if len(family) > 1 and all(w in _GIVEN or len(w) == 1 for w in family[:-1]) and not any(w in _GIVEN for w in given):
                return _split(family + given)
            return tuple(given), _families(family)
        return _split(family or given)
    return _split(tokens(parts[0]))


def _families(words: list[str]) -> tuple[str, ...]:
    return tuple(p for w in words for p in re.split(r"[-‐‑]", w) if p)


def _split(words: list[str]) -> tuple[tuple[str, ...], tuple[str, ...]]:
    if not words:
        return (), ()
    if len(words) == 1:
        return (), _families(words)
    given = [len(w) == 1 or w in _GIVEN for w in words]
    if not given[0] and given[-1]:  # family name first
        first = next(i for i, g in enumerate(given) if g)
        return tuple(words[first:]), _families(words[:first])
    last = 1
    while last < len(words) - 1 and given[last]:
        last += 1
    return tuple(words[:last]), _families(words[last:])


def jaro_winkler(a: str, b: str) -> float:
    """Similarity in 0..1 with a bonus for a common start."""
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(la, lb) // 2 - 1
    used = [False] * lb
    matched = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                matched.append((c, j))
                break
    m = len(matched)
    if not m:
        return 0.0
    other = [b[j] for j in range(lb) if used[j]]
    swaps = sum(x != y for (x, _), y in zip(matched, other, strict=True)) / 2
    jaro = (m / la + m / lb + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, la, lb) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


_SOUND = str.maketrans({**dict.fromkeys("bfpv", "1"), **dict.fromkeys("cgjkqsxz", "2"), **dict.fromkeys("dt", "3"), "l": "4", "m": "5", "n": "5", "r": "6", **dict.fromkeys("aeiouyhw", "0")})


def phonetic(word: str, size: int = 4) -> str:
    """A code of how a word sounds: classes of its consonants, adjacent equal ones once."""
    code = "".join(c for c in word if c.isascii() and c.isalpha()).translate(_SOUND)
    merged = "".join(c for i, c in enumerate(code) if not i or code[i - 1] != c)
    return merged.replace("0", "")[:size]


# Words of institutions' names that tell no two apart.
_GENERIC = frozenset(
    "the of at in and for de la del der die das fur university universitat universidad universite univ uni u college coll institute inst instituto institut technology tech techn technical technische hochschule hs state st medical med school sch main campus center centre faculty dept department office su mu it tu cu ut".split()
)


def institution_words(s: str | None) -> list[str]:
    """Folded words of an institution's name that may tell it from others."""
    if not s:
        return []
    s = re.sub(r"(?<=[a-z])(?=[A-Z]{2,}\b)", " ", s)  # "BereportIT"
    s = re.sub(r"\s+(?:at|-|–|,)\s+.*$", "", s) if re.search(r"\b(?:at|-|–|,)\s+\S+$", s) and len(s.split()) > 2 else s
    return [w for w in re.findall(r"[a-z]+", plain(s)) if w not in _GENERIC and len(w) > 2]
