"""Problem 7: image records and match decisions of the same person, without a common key.

A cascade of rules, each an exact join on a weaker combination of attributes than the
one before. What a pass resolved is out of the next ones: those join what is left of
either side with the whole of the other, so a record that has found one partner can
still be found by another that hasn't. The confidence of a rule is its precision on
labelled pairs, smoothed: on what the rule would accept if one field that it doesn't
use weren't told (the department, or the middle initial for rules that use the
department), a pair is labelled where both sides tell the field, and right where they
agree.

Attributes: given name in full or as initial, family name (as typed, folded), its
one-letter deletions (an exact join on them pairs names one edit apart), institution
and department. Images tell their institution by university, host and storage path,
and their department by the caption; the storage path may tell the full name.

Defined cases: rows without key or with a name of no letters are dropped; a repeated
row counts once; missing institution or department match nothing but are no
contradiction; contradicting given names or middle names reject a pair, departments only where no
institution agrees;
empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm import person
from lectern.llm.names import compared, department, given_alike, institutions
from lectern.operators.components import connected_components
from lectern.session import stored

#: Pseudo-counts of right and wrong pairs that each rule starts from.
PRIOR_RIGHT, PRIOR_WRONG = 2.0, 1.0

_FIELDS = "given string, initial string, middle string, family string, edits array<string>, inst string, dept string"


def _edits(family: str) -> list[str]:
    """The name and each of its one-letter deletions."""
    whole = family.replace(" ", "")
    return sorted({whole} | {whole[:i] + whole[i + 1 :] for i in range(len(whole))}) if len(whole) >= 5 else [whole]


def images(table: DataFrame, inst: DataFrame) -> DataFrame:
    """(key, given, ...) of each image record."""
    known = table.sparkSession.sparkContext.broadcast(institutions(inst))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, name, university, url, path, caption in batch.itertuples(index=False):
                given, family = person.parse(name)
                if not family:
                    continue
                fam = " ".join(sorted(compared(f) for f in family))
                first = person.canonical(given[0]) if given else ""
                stem = re.sub(r"\.\w+$", "", (path or "").rsplit("/", 1)[-1])
                slug, slug_family = person.parse(stem.replace("-", " ").title()) if re.fullmatch(r"[a-z]+(?:-[a-z]+)+", stem) else ((), ())
                if slug and len(slug[0]) > 1:
                    full = person.canonical(slug[0])
                    if not first or len(first) == 1 and full[0] == first or given_alike(first, full):
                        first = full
                    slug_fam = " ".join(sorted(compared(f) for f in slug_family))
                    if slug_fam and person.jaro_winkler(slug_fam, fam) >= 0.9:
                        fam = slug_fam
                where = known.value.of_url(url) or known.value.of_name(university)
                text = caption or ""
                dept = ""
                if text and not any(w in person.plain(text).split() for w in family):
                    part = text.rsplit(",", 1)[-1] if "," in text else text
                    if not re.search(r"(?i)professor|lecturer|instructor|scientist|fellow|portrait|photo", part):
                        dept = department(part)
                out.append((key, first, first[:1], given[1][0] if len(given) > 1 else "", fam, _edits(fam), where, dept))
            yield pd.DataFrame(out, columns=["key", "given", "initial", "middle", "family", "edits", "inst", "dept"])

    one = table.where("profile_id is not null and name is not null").groupBy("profile_id").agg(F.max(F.struct("name", "university", "source_url", "s3_key", "caption")).alias("r"))
    return one.select("profile_id", "r.*").mapInPandas(run, f"key string, {_FIELDS}")


def decisions(table: DataFrame, inst: DataFrame) -> DataFrame:
    """(key, given, ...) of each match decision."""
    known = table.sparkSession.sparkContext.broadcast(institutions(inst))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, name, typed, dept in batch.itertuples(index=False):
                given, family = person.parse(name)
                if not family:
                    continue
                fam = " ".join(sorted(compared(f) for f in family))
                first = person.canonical(given[0]) if given else ""
                out.append((key, first, first[:1], given[1][0] if len(given) > 1 else "", fam, _edits(fam), known.value.of_name(typed), department(dept)))
            yield pd.DataFrame(out, columns=["key", "given", "initial", "middle", "family", "edits", "inst", "dept"])

    one = table.where("decision_id is not null and scholar_name is not null").groupBy("decision_id").agg(F.max(F.struct("scholar_name", "scholar_institution", "scholar_department")).alias("r"))
    return one.select("decision_id", "r.*").mapInPandas(run, f"key string, {_FIELDS}")


#: Name, key expressions (one string each; blank parts match nothing), whether the department is in the key.
RULES: list[tuple[str, list[str], bool]] = [
    ("full name, institution, department", ["given", "family", "inst", "dept"], True),
    ("full name, institution", ["given", "family", "inst"], False),
    ("initial, family, institution, department", ["initial", "family", "inst", "dept"], True),
    ("full name one edit apart, institution", ["given", "edit", "inst"], False),
    ("initial, family, institution", ["initial", "family", "inst"], False),
    ("initial, family one edit apart, institution", ["initial", "edit", "inst"], False),
    ("full name, department", ["given", "family", "dept"], True),
    ("full name", ["given", "family"], False),
    ("full name one edit apart, department", ["given", "edit", "dept"], True),
    ("full name one edit apart", ["given", "edit"], False),
    ("initial, family, department", ["initial", "family", "dept"], True),
]


def _after(base: Column, sep: Column):
    return lambda e: F.concat(base, sep, e)


def _with_each(ends: Column, sep: Column):
    return lambda k: F.transform(ends, lambda e: F.concat(k, sep, e))


def _numbered(n: int):
    return lambda k: F.struct(F.lit(n).alias("rule"), k.alias("key"))


def _keyed(side: DataFrame, rules: list[tuple[str, list[str], bool]], mark: str) -> DataFrame:
    """``side`` once for each rule and join key that it has, with its columns marked.

    Parts that are blank give no key. A rule without institution only joins pairs of
    which one side tells none: such keys end with the side that is blank, so records of
    two different institutions never meet, however common their name.
    """
    sep = F.lit("\x1f")
    keys = []
    for n, (_, parts, _) in enumerate(rules):
        used = parts
        plain = [p for p in used if p != "edit"]
        told = F.lit(True)
        for p in plain:
            told = told & (F.coalesce(F.col(p), F.lit("")) != "")
        if "given" in used:
            told = told & (F.length("given") > 1)
        base = F.concat_ws("\x1f", *plain)
        made = F.transform("edits", _after(base, sep)) if "edit" in used else F.array(base)
        if "inst" not in used:
            other = "b" if mark == "a" else "a"
            # with this side blank every record of the other meets it; a told one only meets a blank one
            ends = F.when(F.coalesce(F.col("inst"), F.lit("")) == "", F.array(F.lit(mark), F.lit(other))).otherwise(F.array(F.lit(other)))
            made = F.flatten(F.transform(made, _with_each(ends, sep)))
        keys.append(F.when(told, F.transform(made, _numbered(n))).otherwise(F.array().cast("array<struct<rule:int,key:string>>")))
    rows = side.withColumn("_k", F.explode(F.concat(*keys)))
    return rows.select(F.col("_k.rule").alias("rule"), F.col("_k.key").alias("_key"), *[F.col(c).alias(f"{mark}_{c}") for c in ("key", "given", "initial", "middle", "family", "inst", "dept")])


def _free(c: str) -> Column:
    """Whether a field contradicts no match: not told on a side, or equal."""
    return (F.col(f"a_{c}") == "") | (F.col(f"b_{c}") == "") | (F.col(f"a_{c}") == F.col(f"b_{c}"))


def _told(c: str) -> Column:
    return (F.col(f"a_{c}") != "") & (F.col(f"b_{c}") != "")


def _names_agree() -> Column:
    """No contradiction of given names or institutions; a given name that no list knows may be a misspelt one."""
    known = sorted(person._GIVEN)
    both_known = F.col("a_given").isin(known) & F.col("b_given").isin(known)
    part = F.array_contains(F.split("a_given", "-"), F.col("b_given")) | F.array_contains(F.split("b_given", "-"), F.col("a_given"))
    given = (F.length("a_given") < 2) | (F.length("b_given") < 2) | (F.col("a_given") == F.col("b_given")) | ~both_known | part
    initial = (F.col("a_initial") == F.col("b_initial")) | (F.col("a_initial") == "") | (F.col("b_initial") == "")
    return _free("inst") & given & initial


def _departments_agree() -> Column:
    """A caption's department speaks against a match only where no institution speaks for it."""
    return _free("dept") | _told("inst")


def cascade(left: DataFrame, right: DataFrame, rules: list[tuple[str, list[str], bool]] = RULES) -> DataFrame:
    """(a, b, rule, rule_name, confidence) of each pair that a rule of the cascade accepts, by its first rule.

    The passes run as one exact join whose key begins with the number of the rule. The
    anti join of a pass then is a comparison: a pair stands if its rule is the first
    that resolved either record, for then that record was still open in its pass. Pairs
    that a weaker rule accepts stand too if both records already belong to one group of
    resolved ones.
    A full name without institution on a side is accepted only where all partners of
    that record by the rule share one institution, an initial (unless the department is
    in the key) only where the full names that it may stand for are one.
    """
    weak = [n for n, (_, parts, _) in enumerate(rules) if "inst" not in parts]
    short = [n for n, (_, parts, _) in enumerate(rules) if "initial" in parts and "dept" not in parts]
    by_dept = [n for n, (_, _, d) in enumerate(rules) if d]
    hits = _keyed(left, rules, "a").join(_keyed(right, rules, "b"), ["rule", "_key"]).where(_names_agree())
    uses = F.col("rule").isin(by_dept)
    fits = _free("middle") & _departments_agree()
    # the field held out of each rule tells whether the pair is right
    label = F.when(uses & _told("middle"), F.col("a_middle") == F.col("b_middle")).when(~uses & _free("middle") & _told("dept"), F.col("a_dept") == F.col("b_dept"))
    every = stored(hits.select("rule", *[f"{s}_{c}" for s in "ab" for c in ("key", "given", "inst")], fits.alias("fits"), label.alias("label")).where("fits or label is not null").distinct(), "p7-hits")
    hits = every.where("fits")
    whole = {s: F.when(F.length(f"{s}_given") > 1, F.col(f"{s}_given")) for s in "ab"}
    kept = every
    for side, other in (("a", "b"), ("b", "a")):
        doubt = (
            hits.where(F.col("rule").isin(weak + short))
            .groupBy("rule", f"{side}_key")
            .agg(
                F.min(f"{other}_inst").alias("low"),
                F.max(f"{other}_inst").alias("high"),
                F.min(F.length(f"{side}_given")).alias("size"),
                F.min(whole[other]).alias("least"),
                F.max(whole[other]).alias("most"),
            )
            .where((F.col("rule").isin(weak) & (F.col("low") != F.col("high"))) | (F.col("rule").isin(short) & (F.col("size") < 2) & (F.col("least") != F.col("most"))))
        )
        kept = kept.join(doubt.select("rule", f"{side}_key"), ["rule", f"{side}_key"], "left_anti")
    sure = stored(kept.select("rule", F.col("a_key").alias("a"), F.col("b_key").alias("b"), "fits", "label"), "p7-kept")
    kept = sure.where("fits").select("rule", "a", "b")
    first = {c: kept.groupBy(c).agg(F.min("rule").alias(f"first_{c}")) for c in "ab"}
    open_still = kept.join(first["a"], "a").join(first["b"], "b").where((F.col("rule") == F.col("first_a")) | (F.col("rule") == F.col("first_b")))
    resolved = stored(open_still.groupBy("a", "b").agg(F.min("rule").alias("rule")), "p7-resolved")
    # pairs whose two records were resolved with others of one group come by their own rule
    group = stored(connected_components(resolved.select(F.concat(F.lit("a"), "a").alias("a"), F.concat(F.lit("b"), "b").alias("b"))), "p7-groups")
    side = {c: group.where(F.col("node").startswith(c)).select(F.expr("substring(node, 2)").alias(c), F.col("component").alias(f"group_{c}")) for c in "ab"}
    rest = kept.groupBy("a", "b").agg(F.min("rule").alias("rule")).join(resolved.select("a", "b"), ["a", "b"], "left_anti")
    late = rest.join(side["a"], "a").join(side["b"], "b").where("group_a = group_b").select("a", "b", "rule")
    pairs = resolved.unionByName(late)
    titles = F.array(*[F.lit(name) for name, _, _ in rules])
    return pairs.join(F.broadcast(precisions(sure, rules)), "rule").withColumn("rule_name", F.element_at(titles, F.col("rule") + 1))


def precisions(pairs: DataFrame, rules: list[tuple[str, list[str], bool]] = RULES) -> DataFrame:
    """(rule, right, labelled, confidence): smoothed precision of each rule on its labelled pairs."""
    counted = pairs.where("label is not null").groupBy("rule").agg(F.count("*").alias("labelled"), F.count_if("label").alias("right"))
    every = pairs.sparkSession.range(len(rules)).select(F.col("id").cast("int").alias("rule"))
    counted = every.join(counted, "rule", "left").select("rule", F.coalesce("labelled", F.lit(0)).alias("labelled"), F.coalesce("right", F.lit(0)).alias("right"))
    return counted.select("rule", "right", "labelled", F.round((F.col("right") + PRIOR_RIGHT) / (F.col("labelled") + PRIOR_RIGHT + PRIOR_WRONG), 4).alias("confidence"))


def matches(image: DataFrame, decision: DataFrame, inst: DataFrame) -> DataFrame:
    """(image_profile_id, decision_id, rule, confidence) of each pair of one person."""
    left = stored(images(image, inst), "p7-images")
    right = stored(decisions(decision, inst), "p7-decisions")
    found = cascade(left, right)
    return found.select(F.col("a").alias("image_profile_id"), F.col("b").alias("decision_id"), F.col("rule_name").alias("rule"), "confidence")
