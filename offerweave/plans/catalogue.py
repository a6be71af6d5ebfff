"""All registered queries of the job-offer engine, and their SQL. Each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerweave.functions import fields, text, vocab
from offerweave.operators import dedup, ingest, normalize, pages, scope, skills, store
from offerweave.operators.tables import Workspace, written
from offerweave.plans.oracles import ORACLES as SQL
from offerweave.plans.oracles import SELECTED
from offerweave.sources import bridge, mappings

AS_OF = datetime(2024, 6, 15)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FLAGSHIP = "skills_by_region"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge offers; every fifth row says whether its salary is predicted."""
    flag = F.when(F.col("ord") % 5 == 4, (F.col("ord") % 2).cast("int"))
    return bridge.offers(spark, sf_dir).withColumn("salary_is_predicted", flag)


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalized(offers(spark, sf_dir), AS_OF)


@query
def eu_jobs_france(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = [F.array_join(c, ",").alias(c) for c in ("countries", "stack")]
    return skills.in_france(bridge.jobs(spark, sf_dir)).select("id", "title", "location", *joined, "salary_min", "posted_at")


def _exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skills.exploded_skills(skills.in_france(bridge.jobs(spark, sf_dir)))


@query
def skills_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(spark, sf_dir).select("id", "title", "region", "competence", "posted_at")


@query
def skills_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skills.counts_by_region(_exploded(spark, sf_dir))


@query
def skills_by_region_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skills.counts_by_region(_exploded(spark, sf_dir), named_only=False)


@query
def aggregate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = skills_by_region(spark, sf_dir)
    n = F.col("nb").cast("string")
    raw = counted.select("competence", "region", F.when(F.col("nb") % 3 == 0, "").otherwise(n).alias("count"), F.when(F.col("nb") % 2 == 0, F.concat(n, F.lit(".5"))).otherwise(n).alias("nb"))
    return skills.aggregate_records(raw)


@query
def volumes_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.volumes(offers(spark, sf_dir), scope.selected(only=SELECTED))


@query
def normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).select("ord", "title_normalized", "company_normalized", "location_normalized", "title_signature", "company_signature", "location_signature")


@query
def normalized_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).select("ord", "contract_type_normalized", "telework_normalized", "url_canonical")


@query
def normalized_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fields.iso_text(fields.parse_timestamp(F.col("c_published_at"), day_first=False))
    return canonical(spark, sf_dir).select("ord", "published_date", "published_iso", stored.alias("stored_iso"), "date_unparsed")


@query
def normalized_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).select("ord", "salary_min_normalized", "salary_max_normalized", "salary_currency", "salary_period", "salary_predicted")


@query
def normalized_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = F.array_join(fields.storage_skills_of_text(F.col("c_skills_text")), "|")
    return canonical(spark, sf_dir).select("ord", F.array_join("skills_normalized", "|").alias("skills_normalized"), stored.alias("stored_skill"))


@query
def completeness_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).select("ord", "completeness_score", "record_preference_score")


@query
def scope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.evaluated(offers(spark, sf_dir)).select("ord", "source", "scope_score", F.array_join("scope_reasons", ",").alias("reasons"), "filter_status")


@query
def scope_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.report(offers(spark, sf_dir))


@query
def match_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bridge.table(spark, sf_dir, "documents").withColumn("folded", text.fold(text.squash(text.text(F.col("text")))))
    return docs.select("doc_id", F.md5("folded").alias("folded_md5"), text.keyword_hits(F.col("folded"), vocab.FOCUS_KEYWORDS).cast("long").alias("focus_hits"))


@query
def slugify_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.table(spark, sf_dir, "part").select("p_partkey", text.slugify(F.col("p_name")).alias("slug"))


@query
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.links(bridge.table(spark, sf_dir, "pages"), r"\A/[a-z]+/?\z")


@query
def page_last_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-1 where a page has no number."""
    return pages.last_page(bridge.table(spark, sf_dir, "pages"), vocab.PAGE_NUMBER_PATTERN).fillna(-1, ["last_page"])


@query
def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.blocks(bridge.table(spark, sf_dir, "pages"), "p")


@query
def offer_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's paragraphs as a list of offers: a card in two has its own id, one in nine leads elsewhere; then read as cards."""
    found = pages.blocks(bridge.table(spark, sf_dir, "pages"), "p").withColumn("n", F.col("position").cast("string"))
    own = F.when(F.col("position") % 2 == 0, F.concat(F.lit(' data-object-id="o'), (F.col("position") / 4).cast("int").cast("string"), F.lit('"'))).otherwise("")
    href = F.when(F.col("position") % 9 == 8, "/fr/pages/x").otherwise(F.concat(F.lit("/fr/companies/c"), (F.col("position") % 5).cast("string"), F.lit("/jobs/job-"), "n"))
    pay = F.when(F.col("position") % 3 == 0, "<div>Salaire : 40K</div>").otherwise("")
    card = F.concat(
        F.lit('<div class=x data-role="jobs:thumb"'), own, F.lit("><div><div><b>"), F.lit("<a href='"), href, F.lit("'>no</a></b></div></div><div><a href='"), href, F.lit("'><h2>Title <em>"), "n", F.lit("</em></h2></a><div><img><span>Firm "),
        F.col("chars").cast("string"), F.lit("</span></div><p>"), F.md5(F.col("label")), F.lit("</p><div><div>CDI</div><div> <div>Paris</div>9</div><div></div><div>Remote</div>"), pay, F.lit("<div>12 collaborateurs</div><div>Banque</div></div><div><time>hier</time></div></div><div><p>no</p></div></div>"),
    )
    lists = found.select("page_id", F.struct("position", card.alias("card")).alias("c")).groupBy("page_id").agg(F.array_sort(F.collect_list("c")).alias("c"))
    made = lists.select("page_id", F.concat(F.lit("<div class='jobs-results-list'>"), F.array_join(F.transform("c", lambda c: c["card"]), "<hr>")).alias("html"))
    return pages.offer_cards(made, "https://site.example.com/x/")


def _of(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return bridge.offers(spark, sf_dir).where(F.col("source") == source)


def _france_travail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as pages of JSON, up to ten in a page, then read and mapped."""
    row = F.struct(
        F.col("ord").cast("string").alias("code"),
        F.col("external_id").alias("id"),
        F.col("title").alias("intitule"),
        "description",
        F.struct(F.col("company_name").alias("nom")).alias("entreprise"),
        F.struct(F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("location_label")).alias("libelle"), F.col("location_label").alias("commune"), F.lit("75001").alias("codePostal")).alias("lieuTravail"),
        F.struct(F.when(F.col("ord") % 2 == 0, F.col("salary")).otherwise("").alias("libelle"), F.col("salary").alias("commentaire")).alias("salaire"),
        F.transform(F.split("skills", ","), lambda x: F.struct(F.lit("none").alias("code"), x.alias("libelle"))).alias("competences"),
        F.col("contract_type").alias("typeContrat"),
        F.when(F.col("ord") % 2 == 0, F.col("contract_type")).otherwise("").alias("typeContratLibelle"),
        F.col("published_at").alias("dateCreation"),
        F.lit("2024-01-01").alias("dateActualisation"),
    )
    raw = _of(spark, sf_dir, "france_travail").select("g", row.alias("row"))
    pages_ = raw.groupBy("g").agg(F.to_json(F.struct(F.collect_list("row").alias("resultats"))).alias("page")).select("page")
    kind = mappings.FT_ROW.replace("struct<id:", "struct<code:string,id:", 1)
    rows = mappings.envelope_rows(pages_, "page", kind, ("resultats", "results", "items"))
    return mappings.france_travail(rows.withColumn("_ord", F.col("code").cast("long")).drop("code"))


@query
def map_france_travail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _france_travail(spark, sf_dir).select(F.col("_ord").alias("ord"), "external_id", "title", "company_name", "location_label", "salary", "contract_type", "published_at", "description", F.array_join("skills", "|").alias("skills"))


@query
def france_travail_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _france_travail(spark, sf_dir)
    keyed = rows.withColumn("k", F.array_join(mappings.france_travail_key(rows), "|"))
    return mappings.first_wins(keyed, ["k"], "_ord").select("k", F.col("_ord").alias("ord"))


def _wttj(rows: DataFrame) -> DataFrame:
    """Fallback rows under French names, half of them with a JSON list of skills."""
    raw = rows.where("source = 'welcome_to_the_jungle'").select(
        F.col("ord").alias("_ord"), F.col("external_id").alias("id"), F.col("title").alias("titre"), F.col("company_name").alias("entreprise"), F.col("location_label").alias("lieu"),
        F.col("salary").alias("salaire"), F.col("published_at").alias("date_publication"), F.when(F.col("ord") % 2 == 0, F.to_json(F.array("skills", F.lit("x")))).otherwise(F.col("skills")).alias("skills"),
        F.col("url").alias("lien"), F.col("description").alias("resume"), F.col("contract_type").alias("contrat"), F.col("telework").alias("teletravail"),
        F.when(F.col("ord") % 3 == 0, "Banque").alias("secteur"), F.when(F.col("ord") % 4 == 1, "12 collaborateurs").otherwise("").alias("taille_entreprise"),
    )
    return mappings.wttj(raw)


@query
def map_wttj(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _wttj(bridge.offers(spark, sf_dir))
    more = ("url", "description", "contract_type", "remote_policy", "sector", "company_size")
    return mapped.select(F.col("_ord").alias("ord"), "external_id", "title", "company", "location", "salary", "published_at", *more, F.array_join("skills", "|").alias("skills"))


BPCE = (
    "_ord", "référence de l'offre", "Visualisation de l'offre", "Titre de l'annonce", "Entreprise", "Ville", "Pays", "salary_min", "salary_max", "Type de contrat", "Date dernière modification", "teletravail",
    "description", "Groupe", "Famille d'emploi", "Emploi", "jobcode", "degree", "nom_recruteur_principal", "email_recruteur_principal", "URL candidature",
)


def _bpce(rows: DataFrame) -> DataFrame:
    """Lines of CSV with semicolons and untidy headers, then read, trimmed and mapped."""
    url = F.when(F.col("ord") % 2 == 0, F.col("url")).otherwise("")
    values = [F.col("ord"), F.col("external_id"), url, F.col("title"), F.col("company_name"), F.col("location_label"), F.lit("France"), *[F.col(c) for c in ("salary_min", "salary_max", "contract_type", "published_at", "telework", "description")]]
    group = F.when(F.col("ord") % 3 == 0, "Groupe")
    values += [group, F.lit(" Famille "), F.lit("Emploi"), F.concat(F.lit("J"), F.col("ord") % 7), F.lit("bac+5"), F.lit("R."), F.concat(F.lit("r"), F.col("g"), F.lit("@example.com")), F.concat(F.lit("https://apply.example.com/"), F.col("ord"))]
    line = F.to_csv(F.struct(*[v.cast("string").alias(f"c{k}") for k, v in enumerate(values)]), {"sep": ";", "quoteAll": "true"})
    lines = rows.where("source = 'bpce'").select(line.alias("line"))
    schema = ", ".join(f"c{k} string" for k in range(len(BPCE)))
    read = lines.select(F.from_csv("line", F.lit(schema), {"sep": ";"}).alias("r")).select(*[F.col(f"r.c{k}").alias(f"\ufeff{n} " if k == 1 else n) for k, n in enumerate(BPCE)])
    read = mappings.not_blank(mappings.trimmed(read), list(BPCE[1:]))
    return mappings.bpce(read.withColumn("_ord", F.col("_ord").cast("long")))


@query
def map_bpce(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _bpce(bridge.offers(spark, sf_dir))
    more = ("application_url", "job_family", "job_label", "job_code", "group_name", "degree", "recruiter_name", "recruiter_email")
    return mapped.select(F.col("_ord").alias("ord"), "external_id", "title", "company_name", "location_label", "salary", "contract_type", "published_at", "url", "telework", *more)


def _ile_de_france(rows: DataFrame) -> DataFrame:
    raw = rows.where("source = 'region_ile_de_france'").select(
        F.col("ord").alias("_ord"), F.col("external_id").alias("id"), F.col("title").alias("Titre du poste"), F.col("company_name").alias("Nom de la collectivité"), F.lit("Entité").alias("Entité"),
        F.col("location_label").alias("Commune du lycée"), F.lit("").alias("Code postal du lycée"), F.lit("Ailleurs").alias("Lieu de Travail"), F.col("published_at").alias("Date de mise en ligne"),
        F.col("description").alias("Vos Missions (format texte)"), F.lit("Votre profil").alias("Votre Profil (format texte)"), F.col("description").alias("Pied de page (format texte)"),
        F.concat(F.lit("- "), "skills", F.lit(" -\nBAC+5\n\n- BAC+5")).alias("Formations obligatoires"), F.col("contract_type").alias("Type de contrat"), F.col("telework").alias("Durée hebdomadaire de travail"),
        F.when(F.col("ord") % 2 == 0, "Informatique").otherwise(" ").alias("Famille de métiers"), F.lit("Data").alias("Fonction"), F.when(F.col("ord") % 3 == 0, "A").alias("Catégorie"), F.lit("Technique").alias("Filière"),
        F.concat(F.lit("Domaine "), F.col("g") % 5).alias("Domaine"), F.lit(" Réseaux ").alias("Spécialité"), F.lit("12 mois").alias("Durée du contrat"), F.lit("2024-09-01").alias("Date de début de contrat"),
    )
    return mappings.ile_de_france(raw)


@query
def map_ile_de_france(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _ile_de_france(bridge.offers(spark, sf_dir))
    more = ("job_family", "job_label", "category", "filiere", "domaine", "speciality", "contract_duration", "contract_start_date")
    return mapped.select(F.col("_ord").alias("ord"), "external_id", "title", "company_name", "location_label", "description", F.array_join("skills", "|").alias("skills"), F.col("weekly_work_duration").alias("weekly"), *more)


def _adzuna(rows: DataFrame) -> DataFrame:
    number = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")).cast("double"), F.lit(0.0)).alias(c)
    row = F.struct(
        F.col("ord").alias("latitude"), F.col("external_id").alias("id"), "title", "description", F.col("published_at").alias("created"), F.col("url").alias("redirect_url"), F.struct(F.col("company_name").alias("display_name")).alias("company"),
        F.struct(F.col("location_label").alias("display_name")).alias("location"), F.when(F.col("g") % 2 == 0, F.struct(F.lit("IT Jobs").alias("label"), F.lit("it-jobs").alias("tag"))).alias("category"),
        number("salary_min"), number("salary_max"), F.when(F.col("ord") % 2 == 0, "oui").otherwise("0").alias("salary_is_predicted"), F.col("contract_type"), F.when(F.col("ord") % 3 == 0, "full_time").alias("contract_time"),
    )
    pages_ = rows.select("g", row.alias("row")).groupBy("g").agg(F.to_json(F.struct(F.collect_list("row").alias("results"))).alias("page")).select("page")
    read = mappings.envelope_rows(pages_, "page", mappings.ADZUNA_ROW, ("results",), bare=False)
    return mappings.adzuna(read.withColumn("_ord", F.col("latitude").cast("long")))


@query
def map_adzuna(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = ("company_name", "location_label", "contract_type", "contract_time", "application_url", "job_family", "job_label", "job_code")
    return _adzuna(bridge.offers(spark, sf_dir)).select(F.col("_ord").alias("ord"), "external_id", "title", "salary", "salary_is_predicted", "category", "url", *more)


@query
def sources_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source's rows the first with each id, rows without one left out; ten orders in turn share an id."""
    shared = F.when(F.col("ord") % 11 == 0, "").otherwise(F.concat(F.lit(" e-"), (F.col("g") / 2).cast("long").cast("string"), F.lit(" ")))
    rows = _landed(spark, sf_dir).withColumn("external_id", shared)
    kept = mappings.adzuna_status(_adzuna(rows)).where("status = 'kept'")
    found = [m.select("source", "external_id", F.col("_ord").alias("ord")) for m in (_wttj(rows), _bpce(rows), _ile_de_france(rows), kept)]
    union = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    return mappings.first_per_id(union, "ord")


@query
def adzuna_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mappings.adzuna_status(_adzuna(bridge.offers(spark, sf_dir)))
    return rows.groupBy("status").agg(F.count("*").alias("offers"), F.sum("salary_is_predicted").alias("predicted"))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge offers as files: what reads them is compiled apart from the bridge's joins, and several readers share them."""
    return written(bridge.offers(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.storage_rows(_landed(spark, sf_dir))


@query
def storage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).select("ord", "source", "external_id", "title", "company", "location", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), F.coalesce(F.get("skills", F.lit(0)), F.lit("")).alias("skills"))


def _first_import(rows: DataFrame) -> DataFrame:
    """Half of the keys, as imported on the first of June; with ``ord``, by which the last row of a key is told."""
    then = fields.as_of_column(datetime(2024, 6, 1))
    return rows.where(F.length("external_id") % 2 == 0).withColumns({"imported_at": then, "updated_at": then})


@query
def upsert_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of half the keys, and a batch of every third row with keys of both kinds: touched buckets are rewritten."""
    with Workspace(spark) as work:
        landed = work.written(bridge.offers(spark, sf_dir))
        rows = work.written(store.storage_rows(landed))
        work.drop(landed)
        table = store.OffersTable(spark, work.path())
        table.create(_first_import(rows), "ord")
        table.upsert(rows.where("ord % 3 = 0").withColumn("title", F.concat("title", F.lit(" *"))), AS_OF)
        day = lambda c: F.date_format(c, "yyyy-MM-dd")
        return written(table.read().select("source", "external_id", "title", day("imported_at").alias("imported"), day("updated_at").alias("updated")))


@query
def adzuna_store_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One portal's loop: filter its rows, put the first of each id in, read the recent history back."""
    with Workspace(spark) as work:
        landed = work.written(bridge.offers(spark, sf_dir))
        kept = mappings.adzuna_status(_adzuna(landed)).where("status = 'kept'")
        batch = work.written(store.storage_rows(mappings.first_per_id(kept, "_ord").withColumnRenamed("_ord", "ord")))
        rows = work.written(store.storage_rows(landed))
        work.drop(landed)
        table = store.OffersTable(spark, work.path())
        table.create(_first_import(rows), "ord")
        work.drop(rows)
        table.upsert(batch, AS_OF)
        back = mappings.history(store.recent(table.read(), AS_OF, 30))
        return written(back.select("origin_source", "external_id", "title", "company_name", "location_label", "published_at"))


@query
def history_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.recent(_stored(spark, sf_dir), AS_OF, 30)
    mapped = mappings.history(rows.withColumn("title", F.concat_ws("#", F.col("ord").cast("string"), "title")))
    return mapped.select(F.substring_index("title", "#", 1).cast("long").alias("ord"), "origin_source", "external_id", "company_name", "location_label", "published_at")


@query
def history_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent rows of a table by month, in order, with their rank."""
    with Workspace(spark) as work:
        rows = mappings.last_wins(_stored(spark, sf_dir), store.KEY, "ord")
        table = store.HistoryTable(spark, work.path())
        table.create(rows.withColumn("imported_at", fields.as_of_column(AS_OF) - F.make_dt_interval(F.col("ord") % 3)))
        return written(table.in_order(AS_OF, 30).select("rank", "ord", "source", "external_id", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published")))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload for ten orders: lists by source, of unlike schemas, and things that are no rows; some are cut off or bare lists."""
    fields_ = ["ord", "external_id", "title", "company_name", "published_at", "url", "description"]
    bank = F.to_json(F.struct(*fields_, F.col("location_label").alias("location"), F.array("skills").alias("skills")))
    other = F.to_json(F.struct(*fields_, "location_label", "skills", F.struct("salary").alias("details")))
    lists = bridge.offers(spark, sf_dir).groupBy("g", "source").agg(F.array_join(F.collect_list(F.when(F.col("source") == "bpce", bank).otherwise(other)), ",").alias("rows"))
    whole = F.concat(F.lit('{"meta":{"n":1},"adzuna":[],"bpce_notes":[1],'), F.array_join(F.collect_list(F.concat(F.lit('"'), F.col("source"), F.lit('":[7,'), F.col("rows"), F.lit("]"))), ","), F.lit("}"))
    cut = F.when(F.col("g") % 7 == 0, F.substring("whole", 1, 60)).when(F.col("g") % 7 == 1, "[1, 2]").otherwise(F.col("whole"))
    return lists.groupBy("g").agg(whole.alias("whole")).select("g", cut.alias("payload"))


@query
def snapshot_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads to stored rows."""
    rows = ingest.snapshot_rows(_payloads(spark, sf_dir))
    kept = store.storage_rows(ingest.offers_of(rows, F.expr("try_variant_get(row, '$.ord', 'long')")))
    return kept.select("ord", "source", "external_id", "title", "company", "location", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), F.coalesce(F.get("skills", F.lit(0)), F.lit("")).alias("skills"))


@query
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.statuses(ingest.snapshot_rows(_payloads(spark, sf_dir)))


@query
def collect_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job over all sources but two: rows of each, none as 0, and the total."""
    rows = _landed(spark, sf_dir)
    skip = ("region_ile_de_france", "hive_aggregates")
    readers = {"france_travail": lambda: _france_travail(spark, sf_dir), "welcome_to_the_jungle": lambda: _wttj(rows), "bpce": lambda: _bpce(rows), "region_ile_de_france": lambda: _ile_de_france(rows)}
    return scope.volumes(ingest.collected(readers, skip=skip), scope.selected(skip=skip))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What duplicates are found by, computed once and written: what follows reads it several times. No text of an offer is among it."""
    judged = normalize.normalized(scope.evaluated(offers(spark, sf_dir)), AS_OF)
    return written(judged.select("ord", "record_preference_score", "scope_score", "completeness_score", "filter_status", *dedup.PROFILE))


@query
def dedup_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).select(F.explode(dedup.block_keys()).alias("key")).groupBy("key").agg(F.count("*").alias("offers"))


@query
def dedup_first_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-1 where no rule links an offer with an earlier one."""
    return dedup.first_matches(_judged(spark, sf_dir)).fillna(-1, ["first_ord"])


@query
def dedup_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.leaders(_judged(spark, sf_dir).where("filter_status = 'kept_offer'"))


@query
def final_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, normalise, find duplicates, merge: one row per offer that is left. Lists are joined by bars."""
    history = F.when(F.col("source") == "postgresql_history", F.when(F.col("ord") % 2 == 0, "france_travail").otherwise("bpce"))
    deadline = F.when(F.col("ord") % 3 == 0, F.col("published_at")).otherwise("")
    raw = offers(spark, sf_dir).withColumns({"origin_source": history, "application_deadline": deadline, "job_code": F.when(F.col("ord") % 4 == 1, F.concat(F.lit("J"), (F.col("ord") % 7).cast("string")))})
    kept = written(normalize.normalized(scope.kept(raw), AS_OF))
    out = dedup.merged(kept, dedup.leaders(kept))
    return out.withColumns({c: F.array_join(c, "|") for c in dedup.LISTS})


ORACLES: dict[str, str] = {name: SQL[name] for name in QUERIES if name in SQL}
