"""Queries that run each collector over responses made from the documents of a profile.

The SQL computes what must come out from the tables themselves, so it shares neither the
shapes of the responses nor the way they are read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import collectors as K
from lectern.plans._base import Registry
from lectern.plans.persons import first_of, last_of, norm
from lectern.sources import read_table

R = Registry()

_ITEMS = f"""m AS (SELECT profile_id, min(profile_name) AS name FROM collected_meta WHERE profile_name IS NOT NULL GROUP BY 1),
    i AS (SELECT d.profile_id, m.name, CAST(doc_id AS VARCHAR) AS id, coalesce(title, 'untitled') AS title, substr(coalesce(text, ''), 1, 400) AS abstract, CASE WHEN doc_id % 3 = 0 THEN 'Zed Otherman' WHEN doc_id % 3 = 1 THEN m.name ELSE {last_of('m.name')} || ', ' || {first_of('m.name')} END AS author,
      CAST(n_chars % 997 AS INTEGER) AS metric, source AS place, '10.1/' || (doc_id // 2) AS doi, 'https://' || source || '/' || (doc_id // 2) AS url, {first_of('m.name')} AS f, {last_of('m.name')} AS l FROM documents d JOIN m ON d.profile_id = m.profile_id)"""

_RULES = {
    "all": "true",
    "last": f"l <> '' AND contains({norm('author')}, l)",
    "last_first3": f"l <> '' AND contains({norm('author')}, l) AND (f = '' OR contains({norm('author')}, substr(f, 1, 3)))",
    "names": f"l <> '' AND {last_of('author')} = l AND f <> '' AND {first_of('author')} <> '' AND (starts_with(f, {first_of('author')}) OR starts_with({first_of('author')}, f))",
    "any_last": f"l <> '' AND {last_of('author')} = l",
    "mentions": f"contains({norm("title || ' ' || abstract")}, {norm('name')}) OR (contains({norm("title || ' ' || abstract")}, f) AND contains({norm("title || ' ' || abstract")}, l))",
}
_RULES["instructor"] = f"({_RULES['names']}) OR (l <> '' AND {last_of('author')} = l AND (f = '' OR {first_of('author')} = '' OR starts_with(f, {first_of('author')}) OR starts_with({first_of('author')}, f)))"
#: What two items may not share: the output field's column here.
_SAME = {"url": "url", "doi": "doi", "title": "title", "video_id": "id"}


def _sql(c: K.Collector) -> str:
    keep = _RULES[c.rule] if c.source != "usaspending" else f"l <> '' AND contains({norm("author || ' ' || title")}, l)"
    if c.source == "github":
        keep = "metric % 5 <> 0"
    if c.source == "opencitations":
        keep = "metric > 0"
    same = _SAME.get(c.unique or "")
    one = f"QUALIFY row_number() OVER (PARTITION BY profile_id, {same} ORDER BY id) = 1" if same else ""
    n = f"least(count(k.id), {c.most})" if c.most else "count(k.id)"
    total = "CAST(sum(k.metric) AS BIGINT)" if c.total else "CAST(NULL AS BIGINT)"
    return f"""WITH {_ITEMS}, k AS (SELECT * FROM i WHERE {keep} {one})
        SELECT p.profile_id, count(k.id) > 0 AS success, CAST({n} AS INTEGER) AS items, {f"CASE WHEN count(k.id) > 0 THEN {total} ELSE 0 END" if c.total else total} AS total FROM (SELECT DISTINCT profile_id FROM i) p LEFT JOIN k ON p.profile_id = k.profile_id GROUP BY 1"""


def _items(spark, d):
    from lectern.functions import persons as P

    m = read_table(spark, d, "collected_meta").where("profile_name is not null").groupBy("profile_id").agg(F.min("profile_name").alias("name"))
    rows = read_table(spark, d, "documents").join(m, "profile_id")
    ends = P.first_last(F.col("name"))
    author = F.when(F.col("doc_id") % 3 == 0, "Zed Otherman").when(F.col("doc_id") % 3 == 1, F.col("name")).otherwise(F.concat(ends["last"], F.lit(", "), ends["first"]))
    half = F.floor(F.col("doc_id") / 2).cast("string")
    return rows.select(
        "profile_id", "name", F.col("doc_id").cast("string").alias("id"), F.coalesce("title", F.lit("untitled")).alias("title"), F.substring(F.coalesce("text", F.lit("")), 1, 400).alias("abstract"), author.alias("author"),
        (F.col("n_chars") % 997).cast("int").alias("metric"), F.lit("2020-01-02").alias("date"), F.concat(F.lit("https://"), "source", F.lit("/"), half).alias("url"), F.concat(F.lit("10.1/"), half).alias("doi"), F.col("source").alias("place"),
    )


def _register(c: K.Collector) -> None:
    def query(spark, d):
        found = K.collected(K.responses(_items(spark, d), c.source, ["profile_id", "name"]), c.source)
        return found.select("profile_id", "success", "items", "total")

    query.__name__ = f"k_{c.source}"
    query.__doc__ = f"The {c.source} collector over one response a profile."
    R.query(_sql(c))(query)


for _c in K.COLLECTORS.values():
    _register(_c)
