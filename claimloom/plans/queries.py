"""Queries on the test tables, and their DuckDB counterparts. """

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.scalar import scrub_emails
from claimloom.operators import facets, fusion
from claimloom.sources.files import table


def stable_ids(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return fusion.stable_ids(p, F.lit("site"), "p_name", ["p_partkey"]).select("p_partkey", "site_id")


FILTERS = {"p_brand": ["Brand#13", "Brand#11"], "p_type": [], "p_size": [24, 10, 5, 30, 1]}


def facet_counts(spark, sf_dir):
    return facets.facet_counts(table(spark, sf_dir, "part").select(*FILTERS), list(FILTERS), FILTERS)


def coverage(spark, sf_dir):
    return facets.coverage(table(spark, sf_dir, "documents").select("text", "lang", "source"), ["text", "lang", "source"])


def top_values(spark, sf_dir):
    return facets.top_values(table(spark, sf_dir, "documents").select("source"), "source")


def email_scrub(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.sha2(scrub_emails(F.coalesce("text", F.lit(""))), 256).alias("scrubbed_sha256"))


QUERIES = {f.__name__: f for f in (stable_ids, facet_counts, coverage, top_values, email_scrub)}
ORACLES = {
    "stable_ids": """WITH b AS (SELECT p_partkey, 'site-' || substr(sha1(p_name), 1, 6) AS id FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p_partkey) AS n FROM b)
SELECT p_partkey, CASE WHEN n = 1 THEN id ELSE id || '-' || n END AS site_id FROM n""",
    "facet_counts": """SELECT 'p_brand' AS facet, p_brand AS value, count(*) AS n FROM part WHERE p_size IN (24, 10, 5, 30, 1) GROUP BY p_brand
UNION ALL SELECT 'p_type', p_type, count(*) FROM part WHERE p_size IN (24, 10, 5, 30, 1) AND p_brand IN ('Brand#13', 'Brand#11') GROUP BY p_type
UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part WHERE p_brand IN ('Brand#13', 'Brand#11') GROUP BY p_size""",
    "coverage": "SELECT field, CAST(sum(known) AS BIGINT) AS known, round(avg(known), 4) AS share FROM (SELECT unnest(['text', 'lang', 'source']) AS field, unnest([(text IS NOT NULL)::INT, (lang IS NOT NULL)::INT, (source IS NOT NULL)::INT]) AS known FROM documents) GROUP BY field",
    "top_values": "SELECT source AS value, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, value NULLS FIRST LIMIT 14",
    "email_scrub": r"SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[הוסר]', 'g')) AS scrubbed_sha256 FROM documents",
}
