"""Problem 2: rows that name the same person, however the name was typed.

Family names are blocked by phonetic codes of their sorted words, within an
institution, and compared by Jaro-Winkler; accepted pairs become clusters by
connected components. Within a cluster and institution, given names are matched by
the nickname table, by Jaro-Winkler and by initials, with departments, middle names
and addresses as evidence for and against. Rows without institution join the one
person of that name whom their department doesn't contradict; where there is none of
exactly that name, the one of a name that is alike by the same blocks and comparisons
over all institutions. What still has no person is compared with its like. There,
families are alike by pairs only: over all institutions components would chain.

Comparisons run on the distinct spellings of a block of one sound and institution,
not on rows, so a name that a third of all rows bear costs as much as a rare one. Only the result, if asked for as pairs, is as large as the
groups demand.

Defined cases: rows without key are dropped; a repeated row counts once (of rows with
equal key and different content the greatest is taken); a null or empty name, or
one without letters, links to nothing; keys that occur in both tables are one key;
empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import namedtuple
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import person
from lectern.operators.components import connected_components
from lectern.operators.grouped import map_sorted_groups
from lectern.operators.joins import BROADCAST_BYTES
from lectern.session import stored

FAMILY_LIKE, FAMILY_NEAR, GIVEN_LIKE, INSTITUTION_LIKE = 0.92, 0.84, 0.84, 0.87
#: Institutions that the comparison holds in every task (a clean list of fixed size).
MAX_INSTITUTIONS = 100_000
#: Keys of one person beyond which its pairs are made in parts.
PAIR_BLOCK = 1000

_SEP = "\x1f"
FIELDS = ("given", "middle", "family", "inst", "dept", "hint", "email")


class Institutions:
    """The clean list of institutions: by domain and by distinctive word."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.by_domain = {}
        self.words = set()
        for name, domain in rows:
            found = person.institution_words(name)
            core = max(found, key=len) if found else person.plain(name or "")
            self.words.add(core)
            if domain:
                self.by_domain[domain.lower()] = core
        self.sorted = sorted(self.words)
        self.memo: dict[str, str] = {}

    def of_host(self, host: str | None) -> str:
        parts = (host or "").lower().strip().split(".")
        for i in range(len(parts)):
            core = self.by_domain.get(".".join(parts[i:]))
            if core:
                return core
        return ""

    def of_url(self, url: str | None) -> str:
        m = re.match(r"^\s*(?:[a-z][a-z0-9+.-]*://)?([^/:?#]+)", (url or "").lower())
        return self.of_host(m.group(1)) if m else ""

    def of_name(self, name: str | None) -> str:
        if not name or not name.strip():
            return ""
        known = self.memo.get(name)
        if known is None:
            found = person.institution_words(re.sub(r"(?<=[^\W\d_])[01](?=[^\W\d_])", lambda m: "o" if m.group() == "0" else "l", name))
            known = next((w for w in found if w in self.words), None)
            if known is None:
                best = max(((person.jaro_winkler(w, c), c) for w in found for c in self.sorted), default=(0.0, ""))
                known = best[1] if best[0] >= INSTITUTION_LIKE else " ".join(found)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[name] = known
        return known


def institutions(table: DataFrame) -> Institutions:
    if table.count() > MAX_INSTITUTIONS:
        raise ValueError("the list of institutions is too long to be held by every task")
    return Institutions(sorted((r.institution_name or "", r.web_domain or "") for r in table.select("institution_name", "web_domain").collect()))


def department(s: str | None) -> str:
    """The first telling word of a department's name."""
    words = [w for w in re.findall(r"[a-z]+", person.plain(s or "")) if w not in ("dept", "department", "of", "school", "faculty", "division", "institute", "the", "for", "portrait")]
    return words[0] if words else ""


def compared(family: str) -> str:
    """A family name as it is compared: umlauts spelt out count as plain, "rn" as "m"."""
    return re.sub(r"(?<=[bcdfghjklmnpqrstvwxz])(?:oe|ae|ue)(?=[bcdfghjklmnpqrstvwxz])", lambda m: m.group()[0], family.replace("rn", "m"))


def _hinted(given: str, family: str, *slugs: str) -> str:
    """A full given name from an address or profile path, where the name has an initial."""
    if len(given) != 1:
        return given
    for slug in slugs:
        parts = [p for p in re.split(r"[^a-z]+", person.plain(slug or "")) if p]
        near = [p for p in parts if any(person.jaro_winkler(p, f) >= FAMILY_LIKE for f in family.split(" "))]
        if near:
            for p in parts:
                if p not in near and len(p) > 2 and p[0] == given and (p in person._GIVEN):
                    return person.canonical(p)
    return given


def people(meta: DataFrame, decisions: DataFrame, inst: DataFrame) -> DataFrame:
    """(key, node, given, middle, family, inst, dept, hint, email) of each key that has a name.

    The field that a directory files a profile under is a hint only: it often differs
    from the person's department, so it never speaks against a match.
    """
    a = meta.select(F.col("profile_id").alias("key"), F.col("profile_name").alias("name"), F.col("profile_url").alias("url"), F.col("source_host").alias("host"), F.lower(F.trim("email")).alias("email"), F.col("field").alias("dept"), F.lit(None).cast("string").alias("inst"))
    b = decisions.select(F.col("decision_id").alias("key"), F.col("scholar_name").alias("name"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("email"), F.col("scholar_department").alias("dept"), F.col("scholar_institution").alias("inst"))
    rows = a.unionByName(b).where("key is not null and name is not null")
    one = rows.groupBy("key").agg(F.max(F.struct("name", "url", "host", "email", "dept", "inst")).alias("r")).select("key", "r.*")
    known = one.sparkSession.sparkContext.broadcast(institutions(inst))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, name, url, host, email, dept, typed in batch.itertuples(index=False):
                given, family = person.parse(name)
                if not family:
                    continue
                typed_by_decision = url is None and host is None
                fam = " ".join(sorted(compared(f) for f in family))
                first = person.canonical(given[0]) if given else ""
                first = _hinted(first, fam, (email or "").split("@")[0], (url or "").rsplit("/", 1)[-1])
                middle = given[1][0] if len(given) > 1 else ""
                where = known.value.of_name(typed) if typed else known.value.of_url(url) or known.value.of_host(host) or known.value.of_host((email or "").rpartition("@")[2])
                out.append((key, first, middle, fam, where, department(dept) if typed_by_decision else "", "" if typed_by_decision else department(dept), email or ""))
            yield pd.DataFrame(out, columns=["key", *FIELDS])

    parsed = one.mapInPandas(run, "key string, " + ", ".join(f"{f} string" for f in FIELDS))
    return parsed.withColumn("node", F.concat_ws(_SEP, *FIELDS))


def family_alike(a: str, b: str) -> bool:
    """Whether two family names (sorted words) may be spellings of one."""
    if a == b:
        return True
    if (" " in a) != (" " in b):  # one of two family names left out
        one, two = (b, a) if " " in a else (a, b)
        return len(one) >= 5 and any(family_alike(one, w) for w in two.split(" "))
    n, m = len(a), len(b)
    if abs(n - m) > 2 or min(n, m) < 4:
        return False
    # what two edits can touch is short once the common start and end are off
    i = 0
    while i < min(n, m) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(n, m) - i and a[n - 1 - j] == b[m - 1 - j]:
        j += 1
    edits = _edits(a[i : n - j], b[i : m - j])
    if edits > 2:
        return False
    near = person.jaro_winkler(a, b)
    return near >= FAMILY_NEAR and edits <= (2 if near >= FAMILY_LIKE and min(n, m) >= 8 else 1)


def _edits(a: str, b: str) -> int:
    """Optimal string alignment distance."""
    prev2, prev = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, prev2[j - 2] + 1)
            row.append(v)
        prev2, prev = prev, row
    return prev[-1]


def codes(family: str) -> list[str]:
    """Phonetic codes of the sorted words: each, the whole, the whole less one sound, the start and the end."""
    whole = "".join(family.split(" "))
    code = person.phonetic(whole, 16)
    parts = {"p" + person.phonetic(w, 16) for w in family.split(" ")}
    return sorted(parts | {"w" + code, "s" + code[:4], "e" + code[-4:]} | {"w" + code[:i] + code[i + 1 :] for i in range(len(code)) if len(code) > 2})


def family_clusters(nodes: DataFrame) -> DataFrame:
    """(inst, family, cluster) of each family name of an institution."""
    names = nodes.select("inst", "family").distinct()

    def spread_codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(i, f, c) for i, f in zip(batch["inst"], batch["family"], strict=True) for c in codes(f)]
            yield pd.DataFrame(out, columns=["inst", "family", "code"])

    blocks = names.mapInPandas(spread_codes, "inst string, family string, code string")

    def link(key: tuple, block: Iterator[tuple]) -> Iterator[tuple]:
        # a spelling is compared with those before it, one link to each group it joins
        groups: list[list[str]] = []
        for f, _ in block:
            joined = [f]
            apart = []
            for g in groups:
                near = next((x for x in g if family_alike(f, x)), None)
                if near is None:
                    apart.append(g)
                else:
                    yield key[0] + _SEP + f, key[0] + _SEP + near
                    joined += g
            groups = [*apart, joined]

    sized = blocks.withColumn("size", F.length("family"))
    edges = map_sorted_groups(sized, ["inst", "code"], ["family", "size"], link, "a string, b string", order=["size", "family"])
    found = connected_components(edges)
    keyed = names.withColumn("node", F.concat_ws(_SEP, "inst", "family"))
    return keyed.join(found, "node", "left").select("inst", "family", F.coalesce("component", "node").alias("cluster"))


def given_alike(a: str, b: str) -> bool:
    """Whether two full given names may be spellings of one; two known names never are."""
    if a == b or a in b.split("-") or b in a.split("-"):
        return True
    return (not (a in person._GIVEN and b in person._GIVEN) and min(len(a), len(b)) >= 3 and person.jaro_winkler(a, b) >= GIVEN_LIKE and _edits(a, b) <= (1 if min(len(a), len(b)) < 7 else 2))


def name_alike(a: str, b: str) -> bool:
    """Whether a given name or initial may stand for another one."""
    return bool(a and b) and (a == b or (b[0] == a if len(a) == 1 else len(b) > 1 and given_alike(a, b)))


def alike_names(loose: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k, f, given, family) of each name of ``loose`` and each of ``nodes`` that may be the same, in whatever institution."""
    families = nodes.groupBy("family").agg(F.max(F.col("inst") == "").alias("is_loose"))

    def spread_codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(f, bool(x), c) for f, x in zip(batch["family"], batch["is_loose"], strict=True) for c in codes(f)]
            yield pd.DataFrame(out, columns=["family", "is_loose", "code"])

    def link(_: tuple, block: Iterator[tuple]) -> Iterator[tuple]:
        held = []  # those of rows without institution, which come first
        for f, is_loose in block:
            for x in held:
                if family_alike(x, f):
                    yield x, f
                    if is_loose:
                        yield f, x
            if is_loose:
                held.append(f)

    blocks = families.mapInPandas(spread_codes, "family string, is_loose boolean, code string").withColumn("last", ~F.col("is_loose"))
    near = map_sorted_groups(blocks, ["code"], ["family", "is_loose", "last"], lambda key, rows: link(key, (r[:2] for r in rows)), "f string, family string", order=["last", "family"]).distinct()
    near = near.unionByName(families.where("is_loose").select(F.col("family").alias("f"), "family"))

    def same(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[name_alike(a, b) for a, b in zip(batch["k"], batch["given"], strict=True)]]

    one = loose.where("k <> ''").select("k", F.col("family").alias("f")).distinct()
    other = nodes.where("given <> ''").select("given", "family").distinct()
    return one.join(near, "f").join(other, "family").select("k", "f", "given", "family").mapInPandas(same, "k string, f string, given string, family string")


def _adrift(left: DataFrame, alike: DataFrame) -> DataFrame:
    """(own, person) of names without institution that no placed person has, joined with their like of one department.

    ``left`` has (k, family, dept, own, may), where ``may`` tells that placed persons may be meant;
    if so, a name without department joins only with its equals.
    """
    one = stored(left.groupBy("own", "k", "family", "dept").agg(F.max("may").alias("may")), "p2-adrift")
    free = one.where("dept <> '' or not may")
    a = free.select("k", F.col("family").alias("f"), "dept", F.col("own").alias("a"))
    b = free.select(F.col("k").alias("given"), "family", "dept", F.col("own").alias("b"))
    both = stored(a.join(alike, ["k", "f"]).join(b, ["given", "family", "dept"]).where("a <> b").select("a", "b", (F.length("k") == F.length("given")).alias("equal"), (F.length("k") > 1).alias("full")), "p2-alike")
    found = stored(connected_components(both.where("equal or full")), "p2-like")
    joined = stored(one.join(found, one["own"] == found["node"], "left").select("own", F.coalesce("component", "own").alias("c")), "p2-joined")
    # an initial joins the only full name that it may stand for
    of = both.where("not equal and not full").join(joined.select(F.col("own").alias("a"), F.col("c").alias("from")), "a").join(joined.select(F.col("own").alias("b"), F.col("c").alias("to")), "b")
    only = of.groupBy("from").agg(F.min("to").alias("to"), F.max("to").alias("most")).where("to = most").select(F.col("from").alias("c"), "to")
    return joined.join(only, "c", "left").select("own", F.coalesce("to", "c").alias("person"))


_Spelling = namedtuple("_Spelling", "given middle dept n")


class _Persons:
    """Disjoint sets of spellings, each with what its members tell."""

    def __init__(self, rows: list[_Spelling]):
        self.up = list(range(len(rows)))
        self.given = [{r.given} - {""} for r in rows]
        self.middle = [{r.middle} - {""} for r in rows]
        self.dept = [{r.dept} - {""} for r in rows]
        self.size = [r.n for r in rows]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def contradict(self, a: int, b: int) -> bool:
        """Whether two sets tell different middle names or departments: where components are cut."""
        return any(x[a] and x[b] and not x[a] & x[b] for x in (self.middle, self.dept))

    def join(self, i: int, j: int, force: bool = False) -> None:
        a, b = self.root(i), self.root(j)
        if a == b or not force and self.contradict(a, b):
            return
        self.up[b] = a
        for x in (self.given, self.middle, self.dept):
            x[a] |= x[b]
        self.size[a] += self.size[b]


def resolve(rows: list[_Spelling], links: list[list[int]] = ()) -> list[int]:
    """A person number for each distinct spelling of one family name at one institution.

    Pairs of full given names that are alike and don't contradict are accepted, the best
    described first, and persons are the components of accepted pairs, cut where the two
    sides tell different middle names or departments. ``links`` are spellings that share
    an address, which stands above a contradiction. An initial joins the one person that
    it may stand for; where several are as likely, initials stay among themselves.
    """
    sets = _Persons(rows)

    def fits(a: str, b: str) -> bool:
        if not a or not b:
            return True
        return given_alike(a, b) if len(a) > 1 and len(b) > 1 else a[0] == b[0]

    for group in links:
        for j in group[1:]:
            if fits(rows[group[0]].given, rows[j].given):
                sets.join(group[0], j, force=True)
    full = [i for i, r in enumerate(rows) if len(r.given) > 1]
    by_given: dict[str, list[int]] = {}
    for i in full:
        by_given.setdefault(rows[i].given, []).append(i)
    names = sorted(by_given)
    alike = {g: [h for h in names if h == g or given_alike(g, h)] for g in names}
    pairs = []
    for g in names:
        for h in alike[g]:
            for i in by_given[g]:
                for j in by_given[h]:
                    a, b = rows[i], rows[j]
                    if i < j and not (a.middle and b.middle and a.middle != b.middle or a.dept and b.dept and a.dept != b.dept):
                        pairs.append((-(4 * (g == h) + 2 * bool(a.dept and a.dept == b.dept) + 2 * bool(a.middle and a.middle == b.middle)), -(a.n + b.n), i, j))
    for _, _, i, j in sorted(pairs):
        sets.join(i, j)
    # a misspelt name belongs to the only person with its initial
    for i in sorted(full, key=lambda i: (rows[i].n, rows[i])):
        own = sets.root(i)
        if all(g not in person._GIVEN for g in sets.given[own]):
            near = {r for k in full if (r := sets.root(k)) != own and any(g[0] == rows[i].given[0] for g in sets.given[r])}
            if len(near) == 1:
                sets.join(near.pop(), i)
    settled = {sets.root(i) for i in full}
    alone: list[int] = []
    short = sorted((i for i, r in enumerate(rows) if len(r.given) < 2), key=lambda i: (-(bool(rows[i].dept) + bool(rows[i].middle)), -rows[i].n, rows[i]))
    for i in short:
        own = sets.root(i)
        if own in {sets.root(k) for k in settled}:
            continue
        may = []
        for k in {sets.root(k) for k in settled}:
            if (not rows[i].given or not sets.given[k] or any(g[0] == rows[i].given[0] for g in sets.given[k])) and not sets.contradict(k, own):
                may.append((2 * bool(sets.dept[k] & sets.dept[own]) + 2 * bool(sets.middle[k] & sets.middle[own]) + min(sets.size[k], 50) / 100, k))
        may.sort(reverse=True)
        if may and (len(may) == 1 or may[0][0] - may[1][0] > 1):
            sets.join(may[0][1], i)
            continue
        same = next((k for k in alone if sets.root(k) != own and fits(rows[k].given, rows[i].given) and bool(rows[k].given) == bool(rows[i].given) and not sets.contradict(sets.root(k), own)), None)
        if same is None:
            alone.append(i)
        else:
            sets.join(same, i)
    return [sets.root(i) for i in range(len(rows))]


def persons(meta: DataFrame, decisions: DataFrame, inst: DataFrame) -> DataFrame:
    """(key, person) of each key with a name; keys of one person share ``person``."""
    rows = stored(people(meta, decisions, inst), "p2-people")
    nodes = stored(rows.groupBy("node", *FIELDS).agg(F.count("*").alias("n")), "p2-nodes")
    placed = nodes.where("inst <> ''")
    clusters = stored(family_clusters(placed), "p2-families")

    named = stored(placed.join(clusters, ["inst", "family"]).select("cluster", "node", "given", "middle", "dept", "email", "n"), "p2-named")
    triple = ["given", "middle", "dept"]
    # what a task holds of a family are its different given names, middle names and departments, and which share an address
    spelt = named.groupBy("cluster", *triple).agg(F.sum("n").alias("n")).select("cluster", F.lit(0).alias("kind"), F.array(*triple).alias("of"), "n")
    shared = named.where("email <> ''").groupBy("cluster", "email").agg(F.collect_set(F.array(*triple)).alias("s")).where("size(s) > 1")
    linked_ = shared.select("cluster", "s").distinct().select("cluster", F.lit(1).alias("kind"), F.flatten(F.array_sort("s")).alias("of"), F.lit(0).cast("bigint").alias("n"))

    def number(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        rows, links = [], []
        for kind, of, n in group:
            if kind == 0:
                rows.append(_Spelling(*of, n))
            else:
                links.append([tuple(of[k : k + 3]) for k in range(0, len(of), 3)])
        at = {(r.given, r.middle, r.dept): i for i, r in enumerate(rows)}
        for r, k in zip(rows, resolve(rows, [[at[t] for t in ts] for ts in links]), strict=True):
            yield key[0], r.given, r.middle, r.dept, f"{key[0]}{_SEP}{k}"

    of_triple = map_sorted_groups(spelt.unionByName(linked_), ["cluster"], ["kind", "of", "n"], number, "cluster string, given string, middle string, dept string, person string", order=["kind", "of"])
    at = stored(named.join(stored(of_triple, "p2-triples"), ["cluster", *triple]).select("node", "person"), "p2-placed")
    loose = nodes.where("inst = ''").select("node", F.col("given").alias("k"), "family", "dept")
    # whom a name and department may mean: persons by full name and by initial
    both = F.explode(F.array_distinct(F.array("given", F.substring("given", 1, 1)))).alias("k")
    known = nodes.join(at, "node").select(both, "family", "dept", "hint", "person")
    told = F.when(F.col("dept") != "", F.col("dept")).when(F.col("hint") != "", F.col("hint"))
    named = known.groupBy("k", "family").agg(F.countDistinct("person").alias("persons"), F.min("person").alias("only"), F.count(told).alias("told"))
    dept = F.when(F.col("dept") != "", F.col("dept")).otherwise(F.col("hint")).alias("dept")
    by_dept = known.select("k", "family", dept, "person").where("dept <> ''").groupBy("k", "family", "dept").agg(F.countDistinct("person").alias("dept_persons"), F.min("person").alias("dept_only"))
    hit = loose.join(named, ["k", "family"], "left").join(by_dept, ["k", "family", "dept"], "left")
    own = F.concat(F.lit("?"), F.concat_ws(_SEP, "k", "family", "dept"))
    # by department where it tells one person, else the only person of that name unless departments differ
    chosen = F.when((F.col("dept") != "") & (F.col("dept_persons") == 1), F.col("dept_only")).when(
        (F.col("persons") == 1) & ((F.col("dept") == "") | (F.col("told") == 0)), F.col("only")
    )
    exact = stored(hit.select("node", "k", "family", "dept", chosen.alias("person"), own.alias("own")), "p2-exact")
    # for the others whoever bears a name that is alike, by the same rules; one person is meant if the least is the greatest
    open_ = exact.where("person is null").drop("person")
    alike = stored(alike_names(open_, nodes), "p2-names")
    people_of = nodes.join(at, "node").select("given", "family", dept, told.alias("told"), "person")
    bounds = F.min("person").alias("least"), F.max("person").alias("most")
    by_name = people_of.groupBy("given", "family").agg(*bounds, F.count("told").alias("told"))
    by_both = people_of.where("dept <> ''").groupBy("given", "family", "dept").agg(*bounds)
    any_of = alike.join(by_name, ["given", "family"]).groupBy("k", "f").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("told").alias("told"))
    any_dept = alike.join(by_both, ["given", "family"]).groupBy("k", "f", "dept").agg(F.min("least").alias("dept_least"), F.max("most").alias("dept_most"))
    may = open_.withColumnRenamed("family", "f").join(any_of, ["k", "f"], "left").join(any_dept, ["k", "f", "dept"], "left")
    meant = F.when(F.col("dept_least") == F.col("dept_most"), F.col("dept_least")).when((F.col("least") == F.col("most")) & ((F.col("dept") == "") | (F.col("told") == 0)), F.col("least"))
    second = stored(may.select("node", "k", F.col("f").alias("family"), "dept", "own", F.col("least").isNotNull().alias("may"), meant.alias("person")), "p2-second")
    left = second.where("person is null")
    adrift = left.select("node", "own").join(_adrift(left, alike), "own").select("node", "person")
    every = at.unionByName(exact.where("person is not null").select("node", "person")).unionByName(second.where("person is not null").select("node", "person")).unionByName(adrift)
    return rows.select("key", "node").join(every, "node").select("key", "person")


def linked(meta: DataFrame, decisions: DataFrame, inst: DataFrame) -> DataFrame:
    """(key, person, links) of each key; ``links`` is the number of other keys of that person."""
    found = stored(persons(meta, decisions, inst), "p2-persons")
    sizes = found.groupBy("person").agg((F.count("*") - 1).alias("links"))
    return found.join(sizes, "person").select("key", F.sha2("person", 256).substr(1, 16).alias("person"), "links")


def pairs(meta: DataFrame, decisions: DataFrame, inst: DataFrame) -> DataFrame:
    """(key_a, key_b) of all pairs of keys of one person, key_a < key_b."""
    found = stored(persons(meta, decisions, inst), "p2-persons")
    hot = found.groupBy("person").agg(F.count("*").alias("n")).where(F.col("n") > PAIR_BLOCK).select("person", F.ceil(F.col("n") / PAIR_BLOCK).cast("int").alias("parts"))
    split = stored(found.join(F.broadcast(hot) if hot.count() * 64 <= BROADCAST_BYTES else hot, "person", "left").select("person", "key", F.coalesce("parts", F.lit(1)).alias("parts")), "p2-split")
    # each key of a person is in one part on one side and in every part on the other
    a = split.select("person", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), F.col("key").alias("key_a"))
    b = split.select("person", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("key").alias("key_b"))
    return a.join(b, ["person", "part"]).where("key_a < key_b").select("key_a", "key_b")
