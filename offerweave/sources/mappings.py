"""Mappings of each source's own rows to raw offers, and which of several rows with one key stays.

Rows come as JSON or CSV texts, one page or line each, or as columns; nothing here opens a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.functions import fields, text

FT_ROW = (
    "struct<id:string,intitule:string,description:string,entreprise:struct<nom:string>,lieuTravail:struct<libelle:string,commune:string,codePostal:string>,"
    "salaire:struct<libelle:string,commentaire:string,complement1:string,complement2:string>,competences:array<struct<code:string,libelle:string>>,"
    "typeContrat:string,typeContratLibelle:string,dateCreation:string,dateActualisation:string>"
)
ADZUNA_ROW = (
    "struct<id:string,title:string,description:string,created:string,redirect_url:string,company:struct<display_name:string>,location:struct<display_name:string>,"
    "category:struct<label:string,tag:string>,salary_min:double,salary_max:double,salary_is_predicted:string,contract_type:string,contract_time:string,"
    "latitude:double,longitude:double>"
)


def first_wins(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The row of smallest ``order`` for each key; an aggregate, so repeated keys shrink before the shuffle."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def last_wins(df: DataFrame, key: list[str], order: str) -> DataFrame:
    return df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def with_id(df: DataFrame) -> DataFrame:
    return df.where(text.strip(text.text(F.col("external_id"))) != "")


def first_per_id(df: DataFrame, order: str) -> DataFrame:
    """Mapped rows with an id, of each source and trimmed id the first in ``order``."""
    own = with_id(df).withColumn("external_id", text.strip(F.col("external_id")))
    return first_wins(own, ["source", "external_id"], order)


def envelope_rows(pages: DataFrame, column: str, row: str, names: tuple[str, ...], bare: bool = True) -> DataFrame:
    """Rows of JSON pages: the first of the envelope's lists that isn't empty, or a bare list."""
    lists = ",".join(f"{n}:array<{row}>" for n in names)
    parsed = F.from_json(column, f"struct<{lists}>")
    found = [F.when(F.size(parsed[n]) > 0, parsed[n]) for n in names]
    if bare:
        found.append(F.from_json(column, f"array<{row}>"))
    others = [c for c in pages.columns if c != column]
    return pages.select(*others, F.explode(F.coalesce(*found)).alias("row")).where("row is not null").select(*others, "row.*")


def france_travail(rows: DataFrame) -> DataFrame:
    """From the columns of FT_ROW; no address is given."""
    skills = F.transform(F.coalesce("competences", F.array().cast("array<struct<code:string,libelle:string>>")), lambda c: text.or_chain(c["libelle"], c["code"]))
    return rows.select(
        *[c for c in rows.columns if c.startswith("_")],
        F.lit("france_travail").alias("source"),
        F.col("id").alias("external_id"),
        F.col("intitule").alias("title"),
        F.col("entreprise.nom").alias("company_name"),
        text.or_chain(F.col("lieuTravail.libelle"), F.col("lieuTravail.commune"), F.col("lieuTravail.codePostal")).alias("location_label"),
        text.or_chain(*[F.col(f"salaire.{n}") for n in ("libelle", "commentaire", "complement1", "complement2")]).alias("salary"),
        text.or_chain(F.col("typeContratLibelle"), F.col("typeContrat")).alias("contract_type"),
        text.or_chain(F.col("dateCreation"), F.col("dateActualisation")).alias("published_at"),
        "description",
        F.filter(skills, lambda s: text.strip(text.text(s)) != "").alias("skills"),
    )


def france_travail_key(df: DataFrame) -> Column:
    """What tells one offer from another over queries: the id, else title, company, place and date."""
    other = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "company_name", "location_label", "published_at")]
    return F.when(text.text(F.col("external_id")) != "", F.array(F.lit("id"), "external_id")).otherwise(F.array(F.lit("secours"), *other))


def wttj(rows: DataFrame) -> DataFrame:
    """From fallback columns under their French or English names; skills only where they are a JSON list."""
    pick = lambda *names: text.or_chain(*[F.col(n) for n in names if n in rows.columns] or [F.lit(None)])
    skills = pick("skills")
    return rows.select(
        *[c for c in rows.columns if c.startswith("_")],
        F.lit("welcome_to_the_jungle").alias("source"),
        pick("external_id", "id").alias("external_id"),
        pick("title", "titre").alias("title"),
        pick("company", "entreprise").alias("company"),
        pick("location", "lieu").alias("location"),
        pick("salary", "salaire").alias("salary"),
        pick("published_at", "date_publication").alias("published_at"),
        pick("url", "lien").alias("url"),
        pick("description", "resume").alias("description"),
        pick("contract_type", "contrat").alias("contract_type"),
        pick("remote_policy", "teletravail").alias("remote_policy"),
        pick("sector", "secteur").alias("sector"),
        pick("company_size", "taille_entreprise").alias("company_size"),
        F.when(F.startswith(F.ltrim(skills), F.lit("[")), F.from_json(skills, "array<string>")).otherwise(F.array().cast("array<string>")).alias("skills"),
    )


def trimmed(df: DataFrame) -> DataFrame:
    """Column names and texts without white space around (and a byte order mark); columns without a name go."""
    names = {c: c.replace("﻿", "").strip(text.SPACES) for c in df.columns}
    return df.select(*[text.strip(F.col(f"`{c}`").cast("string")).alias(n) if df.schema[c].dataType.typeName() == "string" else F.col(f"`{c}`").alias(n) for c, n in names.items() if n])


def not_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(text.first_non_blank(*[F.col(f"`{c}`") for c in columns]) != "")


def joined_parts(*parts: Column) -> Column:
    """Ordered distinct non-blank parts, joined by a comma."""
    return F.array_join(F.array_distinct(F.filter(F.array(*[text.strip(text.text(p)) for p in parts]), lambda x: x != "")), ", ")


def _cleaned(rows: DataFrame) -> DataFrame:
    """Every column as a trimmed text, '' for null; those that begin with an underscore as they are."""
    return text.staged(rows, {n: F.col(f"`{n}`") if n.startswith("_") else text.strip(text.text(F.col(f"`{n}`"))) for n in rows.columns})


def _first_of(rows: DataFrame, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(F.col(f"`{n}`"), F.lit("")) for n in names if n in rows.columns], F.lit(""))


def bpce(rows: DataFrame) -> DataFrame:
    """From the portal's French headers."""
    rows = _cleaned(rows)
    c = lambda *names: _first_of(rows, names)
    url = c("Visualisation de l'offre")
    title, company = c("Titre de l'annonce"), c("Entreprise", "Groupe")
    place = joined_parts(c("Ville"), c("Région"), c("Pays"))
    own = F.coalesce(F.nullif(c("référence de l'offre", "reference de l'offre"), F.lit("")), F.nullif(url, F.lit("")), F.lit(""))
    return rows.select(
        *[x for x in rows.columns if x.startswith("_")],
        F.lit("bpce").alias("source"),
        text.fallback_id(own, "bpce_", [title, company, place, c("Date dernière modification")]).alias("external_id"),
        title.alias("title"),
        company.alias("company"),
        company.alias("company_name"),
        place.alias("location"),
        place.alias("location_label"),
        fields.bounds_label(c("salary_min"), c("salary_max")).alias("salary"),
        c("salary_min").alias("salary_min"),
        c("salary_max").alias("salary_max"),
        c("Type de contrat").alias("contract_type"),
        c("Date dernière modification").alias("published_at"),
        url.alias("url"),
        c("URL candidature").alias("application_url"),
        F.lit("").alias("application_deadline"),
        c("description").alias("description"),
        F.array().cast("array<string>").alias("skills"),
        c("Famille d'emploi").alias("job_family"),
        c("Emploi").alias("job_label"),
        c("jobcode").alias("job_code"),
        c("Groupe").alias("group_name"),
        c("teletravail").alias("telework"),
        c("degree").alias("degree"),
        c("nom_recruteur_principal").alias("recruiter_name"),
        c("email_recruteur_principal").alias("recruiter_email"),
    )


def ile_de_france(rows: DataFrame) -> DataFrame:
    """From the region's French headers."""
    rows = _cleaned(rows)
    c = lambda *names: _first_of(rows, names)
    title, employer = c("Titre du poste"), c("Nom de la collectivité", "Entité", "Nom de l'établissement")
    place = joined_parts(c("Commune du lycée"), c("Code postal du lycée"))
    place = F.when(place != "", place).otherwise(c("Localisation", "Lieu de Travail", "Adresse lieu de travail"))
    blocks = [c(n) for n in ("Définition de la mission", "Vos Missions (format texte)", "Votre Profil (format texte)", "Spécificités du poste (format texte)", "Pied de page (format texte)")]
    description = F.array_join(F.array_distinct(F.filter(F.array(*blocks), lambda x: x != "")), "\n\n")
    lines = F.transform(F.split(c("Formations obligatoires"), r"\R"), lambda x: F.trim(x, F.lit(" -\t\r\n")))
    return rows.select(
        *[x for x in rows.columns if x.startswith("_")],
        F.lit("region_ile_de_france").alias("source"),
        text.fallback_id(c("id", "ref"), "idf_", [title, employer, place, c("Date de mise en ligne")]).alias("external_id"),
        title.alias("title"),
        employer.alias("company"),
        employer.alias("company_name"),
        place.alias("location"),
        place.alias("location_label"),
        F.lit("").alias("salary"),
        c("Type de contrat").alias("contract_type"),
        c("Date de mise en ligne").alias("published_at"),
        F.lit("").alias("application_deadline"),
        F.lit("").alias("url"),
        description.alias("description"),
        F.array_distinct(F.filter(lines, lambda x: x != "")).alias("skills"),
        c("Famille de métiers").alias("job_family"),
        c("Fonction").alias("job_label"),
        c("Catégorie").alias("category"),
        c("Filière").alias("filiere"),
        c("Domaine").alias("domaine"),
        c("Spécialité").alias("speciality"),
        c("Durée hebdomadaire de travail").alias("weekly_work_duration"),
        c("Durée du contrat").alias("contract_duration"),
        c("Date de début de contrat").alias("contract_start_date"),
    )


def adzuna(rows: DataFrame) -> DataFrame:
    """From the columns of ADZUNA_ROW; texts trimmed, what is missing as ''."""
    t = lambda c: text.strip(text.text(F.col(c)))
    company, place, label, url = t("company.display_name"), t("location.display_name"), t("category.label"), t("redirect_url")
    return rows.select(
        *[x for x in rows.columns if x.startswith("_")],
        F.lit("adzuna").alias("source"),
        t("id").alias("external_id"),
        t("title").alias("title"),
        company.alias("company"),
        company.alias("company_name"),
        place.alias("location"),
        place.alias("location_label"),
        fields.bounds_label(F.col("salary_min"), F.col("salary_max"), numeric=True).alias("salary"),
        "salary_min",
        "salary_max",
        text.lenient_bool(F.col("salary_is_predicted"), False).cast("int").alias("salary_is_predicted"),
        t("contract_type").alias("contract_type"),
        t("contract_time").alias("contract_time"),
        t("created").alias("published_at"),
        F.lit("").alias("application_deadline"),
        url.alias("url"),
        url.alias("application_url"),
        t("description").alias("description"),
        F.array().cast("array<string>").alias("skills"),
        label.alias("job_family"),
        label.alias("job_label"),
        t("category.tag").alias("job_code"),
        label.alias("category"),
        "latitude",
        "longitude",
    )


def adzuna_status(df: DataFrame, exclude_predicted: bool = True) -> DataFrame:
    """Adds ``status``: no_salary, predicted, no_id or kept. Amounts of 0 are missing."""
    pay = (F.coalesce("salary_min", F.lit(0.0)) != 0) | (F.coalesce("salary_max", F.lit(0.0)) != 0)
    status = F.when(~pay, "no_salary")
    if exclude_predicted:
        status = status.when(F.col("salary_is_predicted") != 0, "predicted")
    return df.withColumn("status", status.when(text.strip(text.text(F.col("external_id"))) == "", "no_id").otherwise("kept"))


def history(rows: DataFrame) -> DataFrame:
    """Stored rows as offers of the history source; their own source becomes origin_source."""
    return rows.select(
        F.lit("postgresql_history").alias("source"),
        F.col("source").alias("origin_source"),
        "external_id",
        "title",
        text.strip(F.coalesce(text.or_chain(F.col("company_name"), F.col("company")), F.lit(""))).alias("company_name"),
        text.strip(F.coalesce(text.or_chain(F.col("location_label"), F.col("location")), F.lit(""))).alias("location_label"),
        F.coalesce("published_at_raw", F.col("published_at").cast("string")).alias("published_at"),
        F.coalesce("skills", F.array().cast("array<string>")).alias("skills"),
    )
