"""Offers and jobs made from the given tables: every order, document and page, each text and address once.

The same statement runs on Spark ({orders} is a DataFrame) and on DuckDB (it is a view), so each query and the SQL
it is checked with begin from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OFFERS = """
SELECT r.*,
  CASE WHEN ord % 11 = 0 THEN '' ELSE 'ext-' || CAST(ord AS STRING) END AS external_id,
  CASE ord % 4 WHEN 0 THEN base WHEN 1 THEN base || ' (H/F)' WHEN 2 THEN 'Senior ' || base ELSE '  ' || upper(base) || ' ' END AS title,
  CASE WHEN ord % 13 = 0 THEN '' ELSE 'Société ' || CAST(g % 37 AS STRING) || ' &amp; Cie' END AS company_name,
  CASE g % 4 WHEN 0 THEN 'Paris 0' || CAST(1 + g % 9 AS STRING) WHEN 1 THEN 'Lyon' WHEN 2 THEN 'Île-de-France' ELSE '' END AS location_label,
  CASE ord % 6 WHEN 0 THEN '40k - 45k' WHEN 1 THEN CAST(30000 + g % 20000 AS STRING) || ' - ' || CAST(25000 + g % 30000 AS STRING)
    WHEN 2 THEN '35 000 - 45 000 €' WHEN 3 THEN 'Mensuel de 2500.0 Euros sur 12 mois' WHEN 4 THEN '40-45K' ELSE '' END AS salary,
  CASE WHEN ord % 9 = 0 THEN CAST(28000 + g % 9000 AS STRING) ELSE '' END AS salary_min,
  CASE WHEN ord % 18 = 0 THEN CAST(39000 + g % 9000 AS STRING) ELSE '' END AS salary_max,
  CASE ord % 5 WHEN 0 THEN 'CDI - Temps plein' WHEN 1 THEN 'Contrat d''apprentissage' WHEN 2 THEN 'CDD' WHEN 3 THEN 'VIE' ELSE '' END AS contract_type,
  CASE ord % 6 WHEN 0 THEN '100% remote' WHEN 1 THEN 'Full remote' WHEN 2 THEN 'Télétravail partiel' WHEN 3 THEN 'Sur site' WHEN 4 THEN '37h30' ELSE '' END AS telework,
  CASE ord % 7 WHEN 0 THEN '' WHEN 1 THEN substring(d, 9, 2) || '/' || substring(d, 6, 2) || '/' || substring(d, 1, 4)
    WHEN 2 THEN d || 'T10:00:00.000Z' WHEN 3 THEN 'il y a 3 jours' WHEN 4 THEN replace(d, '-', '') ELSE d END AS published_at,
  CASE WHEN page_url IS NOT NULL THEN page_url WHEN source IN ('bpce', 'postgresql_history') THEN 'HTTPS://Jobs.Example.com/offres/' || CAST(g AS STRING) || '/?id=' || CAST(ord AS STRING) ELSE '' END AS url,
  CASE ord % 4 WHEN 0 THEN 'Python; SQL | python, Spark/Kafka' WHEN 1 THEN 'Power BI, Tableau, R&amp;D' WHEN 2 THEN '' ELSE 'Gestion' END AS skills,
  CASE WHEN body IS NOT NULL THEN body WHEN ord % 8 = 0 THEN '' WHEN ord % 8 = 1 THEN 'Reporting et SQL sur le cloud' ELSE 'Poste basé à ' || CAST(g % 50 AS STRING) || ' minutes' END AS description
FROM (
  SELECT ord, CAST(floor(ord / 10) AS BIGINT) AS g, body, page_url,
    CASE ord % 5 WHEN 0 THEN 'france_travail' WHEN 1 THEN 'welcome_to_the_jungle' WHEN 2 THEN 'bpce' WHEN 3 THEN 'region_ile_de_france' ELSE 'postgresql_history' END AS source,
    CASE CAST(floor(ord / 10) AS BIGINT) % 12 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'Ingénieur données' WHEN 2 THEN 'Data Scientist NLP'
      WHEN 3 THEN 'Analyste BI' WHEN 4 THEN 'Consultant reporting SQL' WHEN 5 THEN 'Comptable' WHEN 6 THEN 'Architecte cloud AWS'
      WHEN 7 THEN 'Développeur Python' WHEN 8 THEN 'Machine Learning Engineer' WHEN 9 THEN 'Chef de cuisine' WHEN 10 THEN 'Développeur Big Data' ELSE '' END AS base,
    '2024-' || lpad(CAST(1 + CAST(floor(ord / 10) AS BIGINT) % 12 AS STRING), 2, '0') || '-' || lpad(CAST(1 + CAST(floor(ord / 10) AS BIGINT) % 28 AS STRING), 2, '0') AS d
  FROM (
    SELECT coalesce(k.o_orderkey, b.doc_id * 15, p.page_id * 60) AS ord, b.text AS body, p.url AS page_url
    FROM {orders} k
    FULL OUTER JOIN {documents} b ON b.doc_id * 15 = k.o_orderkey
    FULL OUTER JOIN {pages} p ON p.page_id * 60 = coalesce(k.o_orderkey, b.doc_id * 15)
  ) u
) r
"""

JOBS = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id, 'Brand-' || CAST(l_suppkey % 10 AS STRING) AS company_slug,
  CASE l_partkey % 3 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'Backend Developer' ELSE 'ML Engineer' END AS title,
  'https://jobs.example.com/' || CAST(l_orderkey AS STRING) AS url,
  CASE l_suppkey % 6 WHEN 0 THEN 'Paris' WHEN 1 THEN 'Berlin' WHEN 2 THEN 'Lyon, France' WHEN 3 THEN 'Madrid' WHEN 4 THEN '' END AS location,
  CASE l_partkey % 4 WHEN 0 THEN split('FR', ',') WHEN 1 THEN split('DE,FR', ',') WHEN 2 THEN split('ES', ',') END AS countries,
  'hybrid' AS remote_policy, 'mid' AS seniority, 'data' AS role_family, l_extendedprice AS salary_min, l_extendedprice * 2 AS salary_max,
  'EUR' AS salary_currency, 'yearly' AS salary_period,
  CASE l_orderkey % 5 WHEN 0 THEN split('python,sql', ',') WHEN 1 THEN split('spark,kafka,scala', ',') WHEN 2 THEN split('dbt', ',') WHEN 3 THEN split('', ',') END AS stack,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS posted_at, 'bridge' AS source
FROM {lineitem}
"""

NAMES = ("orders", "documents", "pages", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """A statement of this module over the tables of ``sf_dir``."""
    return spark.sql(statement, **{n: table(spark, sf_dir, n) for n in NAMES if f"{{{n}}}" in statement})


def duck(statement: str) -> str:
    """The same statement for DuckDB."""
    return statement.format(**{n: n for n in NAMES})


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, OFFERS)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, JOBS)
