"""Queries of the engine's own operators over the whole tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import jsonx, text
from quillstone.functions.mappers import au, common, sa, us
from quillstone.operators import fold, promote, repair, tables
from quillstone.plans import pipeline
from quillstone.session import ensure_checkpoint_dir
from quillstone.sources import documents as docs
from quillstone.sources.catalog import Catalog
from quillstone.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

#: Target of the chunk queries: small, so that every document exercises the packing.
SMALL = 100

_REGISTRY: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of the catalog as a query under its name, with its SQL."""

    def add(f: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
        _REGISTRY[f.__name__] = lambda spark, root: f(Catalog(spark, root))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def long(name: str) -> F.Column:
    return F.col(name).cast("long").alias(name)


# ---- promotion

_GEO = """
keyed AS (SELECT id AS country_id, nullif(upper(trim(code)), '') AS code, nullif(upper(trim(name)), '') AS name FROM source_country),
g AS (SELECT id, upper(trim(country_code)) AS code, upper(trim(country_name)) AS name, agency_acronym FROM regulatory_geography),
by_code AS (SELECT code, min(id) AS id FROM g WHERE code <> '' GROUP BY code), by_name AS (SELECT name, min(id) AS id FROM g WHERE name <> '' GROUP BY name),
geo AS (SELECT k.country_id, coalesce(c.id, n.id) AS geography_id FROM keyed k LEFT JOIN by_code c ON c.code = k.code LEFT JOIN by_name n ON n.name = k.name)"""

_CANDIDATES = ["$.detail.registration_number", *(f"$.{k}" for k in jsonx.REGISTRATION_KEYS)]
_NUMBER = "coalesce(" + ", ".join(f"CASE WHEN regexp_matches(json_extract_string(json_data, '{p}'), '[0-9]') AND trim(json_extract_string(json_data, '{p}')) NOT IN ('0') THEN trim(json_extract_string(json_data, '{p}')) END" for p in _CANDIDATES) + ")"


@query("SELECT r.id::BIGINT AS id, r.name, r.feed, r.file_seq::BIGINT AS file_seq FROM drug_predicate_raw_records r ANTI JOIN products p ON p.raw_record_id = r.id")
def promote_pending(t: Catalog) -> DataFrame:
    return promote.pending(t.table("drug_predicate_raw_records"), t.table("products")).select(long("id"), "name", "feed", long("file_seq"))


@query("SELECT c.name AS country_name, count(*) AS pending FROM drug_predicate_raw_records r ANTI JOIN products p ON p.raw_record_id = r.id LEFT JOIN source_country c ON c.id = r.country_id GROUP BY c.name")
def pending_counts(t: Catalog) -> DataFrame:
    return promote.pending_counts(t.table("drug_predicate_raw_records"), t.table("products"), t.table("source_country"))


@query(f"WITH {_GEO} SELECT geo.country_id::BIGINT AS country_id, geo.geography_id::VARCHAR AS geography_id, r.agency_acronym AS agency FROM geo LEFT JOIN regulatory_geography r ON r.id = geo.geography_id")
def geo_resolve(t: Catalog) -> DataFrame:
    return promote.resolve_geography(t.table("source_country"), t.table("regulatory_geography")).select(long("country_id"), F.col("geography_id").cast("string"), "agency")


@query(f"SELECT id::BIGINT AS id, feed, file_seq::BIGINT AS file_seq, {_NUMBER} AS registration_number FROM drug_predicate_raw_records")
def registration_guess(t: Catalog) -> DataFrame:
    return t.table("drug_predicate_raw_records").select(long("id"), "feed", long("file_seq"), jsonx.registration_number(F.col("json_data")).alias("registration_number"))


@query(f"""
WITH {_GEO},
latest AS (SELECT * FROM drug_predicate_raw_records QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawled_at DESC, feed DESC, file_seq DESC) = 1),
rows AS (SELECT l.id AS raw_record_id, l.name AS product_name, geo.geography_id AS country_id, g.agency_acronym AS regulator, {_NUMBER} AS registration_number, l.document_url[1] AS source_url
         FROM latest l ANTI JOIN products p ON p.raw_record_id = l.id LEFT JOIN geo ON geo.country_id = l.country_id LEFT JOIN regulatory_geography g ON g.id = geo.geography_id),
free AS (SELECT * FROM rows ANTI JOIN products p ON p.country_id = rows.country_id AND p.registration_number = rows.registration_number),
once AS (SELECT *, row_number() OVER (PARTITION BY country_id, registration_number ORDER BY raw_record_id) AS rn FROM free)
SELECT md5('raw:' || raw_record_id) AS id, raw_record_id::BIGINT AS raw_record_id, product_name, country_id::BIGINT AS country_id, regulator, registration_number, source_url
FROM once WHERE rn = 1 OR country_id IS NULL OR registration_number IS NULL""")
def promote_insert(t: Catalog) -> DataFrame:
    new = promote.promote(t.table("drug_predicate_raw_records"), t.table("products"), t.table("source_country"), t.table("regulatory_geography"))
    return new.select("id", long("raw_record_id"), "product_name", long("country_id"), "regulator", "registration_number", "source_url")


@query("SELECT country_id::BIGINT AS country_id, registration_number, count(*) AS n FROM products WHERE country_id IS NOT NULL AND registration_number IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def unique_violations(t: Catalog) -> DataFrame:
    return tables.assert_unique(t.table("products"), ["country_id", "registration_number"]).select(long("country_id"), "registration_number", "n")


# ---- text

_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_NORM = _STRIP.format(r"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n|\r', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")
_TOK = "greatest(1, length({}) // 4)"


@query(f"SELECT doc_id, {_TOK.format('text')}::BIGINT AS n_tokens FROM documents")
def token_counts(t: Catalog) -> DataFrame:
    return t.table("documents").select("doc_id", text.count_tokens(F.col("text")).cast("long").alias("n_tokens"))


@query(f"SELECT doc_id, length({_NORM}) AS n_chars, md5({_NORM}) AS digest FROM documents")
def normalize_text(t: Catalog) -> DataFrame:
    norm = text.normalize(F.col("text"))
    return t.table("documents").select("doc_id", norm.alias("n")).select("doc_id", F.length("n").cast("long").alias("n_chars"), F.md5("n").alias("digest"))


@query(rf"""
WITH d AS (SELECT doc_id, {_NORM} AS n FROM documents),
s AS (SELECT doc_id, string_split(regexp_replace(n, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM d)
SELECT doc_id, len(parts)::BIGINT AS n_sentences, list_max(list_transform(parts, lambda x: length(x)))::BIGINT AS longest FROM s""")
def sentence_split(t: Catalog) -> DataFrame:
    parts = t.table("documents").select("doc_id", text.sentences(text.normalize(F.col("text"))).alias("p"))
    return parts.select("doc_id", F.size("p").cast("long").alias("n_sentences"), F.array_max(F.transform("p", F.length)).cast("long").alias("longest"))


def _pack_sql(units: str, joiner: str) -> str:
    """SQL of a greedy pack of a list of strings, as a fold over the list."""
    size = _TOK.format("x.u")
    step = (
        f"CASE WHEN len(a.open) > 0 AND a.n + {size} > {SMALL} THEN {{'done': list_append(a.done, array_to_string(a.open, {joiner})), 'open': [x.u], 'n': {size}, 'u': ''}} "
        f"ELSE {{'done': a.done, 'open': list_append(a.open, x.u), 'n': a.n + {size}, 'u': ''}} END"
    )
    start = "{'done': []::VARCHAR[], 'open': []::VARCHAR[], 'n': 0::BIGINT, 'u': ''}"
    fold_ = f"list_reduce(list_prepend({start}, list_transform({units}, lambda u: {{'done': []::VARCHAR[], 'open': []::VARCHAR[], 'n': 0::BIGINT, 'u': u}})), lambda a, x: {step})"
    return f"list_transform([{fold_}], lambda r: CASE WHEN len(r.open) > 0 THEN list_append(r.done, array_to_string(r.open, {joiner})) ELSE r.done END)[1]"


_PARAS = rf"list_filter(list_transform(string_split_regex(n, '\n\s*\n'), lambda p: {_STRIP.format('p')}), lambda p: p <> '')"
_CHUNKS = rf"""
d AS (SELECT doc_id, {_NORM} AS n FROM documents),
para AS (SELECT doc_id, n, unnest({_PARAS}) AS p, generate_subscripts({_PARAS}, 1) AS i FROM d WHERE n <> '' AND {_TOK.format('n')} > {SMALL}),
packed AS (SELECT doc_id, i, CASE WHEN {_TOK.format('p')} > {SMALL} THEN {_pack_sql(r"string_split(regexp_replace(p, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))", "' '")} ELSE [p] END AS u FROM para),
units AS (SELECT doc_id, flatten(list(u ORDER BY i)) AS u FROM packed GROUP BY doc_id),
plain AS (SELECT doc_id, {_pack_sql("u", "chr(10) || chr(10)")} AS c FROM units UNION ALL SELECT doc_id, [n] FROM d WHERE n <> '' AND {_TOK.format('n')} <= {SMALL}),
flat AS (SELECT doc_id, unnest(c) AS chunk, generate_subscripts(c, 1) - 1 AS chunk_index FROM plain)"""


@query(f"WITH {_CHUNKS} SELECT doc_id, chunk_index::BIGINT AS chunk_index, length(chunk) AS char_count, md5(chunk) AS digest FROM flat")
def chunk_pack(t: Catalog) -> DataFrame:
    flat = t.table("documents").select("doc_id", F.posexplode(text.plain_chunks(F.col("text"), SMALL)).alias("chunk_index", "chunk"))
    return flat.select("doc_id", long("chunk_index"), F.length("chunk").cast("long").alias("char_count"), F.md5("chunk").alias("digest"))


@query(f"""
WITH {_CHUNKS},
led AS (SELECT doc_id, chunk_index, chunk, lag(chunk) OVER (PARTITION BY doc_id ORDER BY chunk_index) AS before FROM flat),
tail AS (SELECT *, greatest(1, floor({_TOK.format('before')} * 0.15))::BIGINT * 4 AS k FROM led)
SELECT doc_id, chunk_index::BIGINT AS chunk_index, md5(CASE WHEN before IS NULL THEN chunk ELSE {_STRIP.format("CASE WHEN length(before) > k THEN right(before, k) ELSE before END")} || chr(10) || chr(10) || chunk END) AS digest FROM tail""")
def chunk_overlap(t: Catalog) -> DataFrame:
    flat = t.table("documents").select("doc_id", F.posexplode(text.chunks(F.col("text"), SMALL)).alias("chunk_index", "chunk"))
    return flat.select("doc_id", long("chunk_index"), F.md5("chunk").alias("digest"))


_ANNEXED = "'see ANNEX I and Annex III' || chr(10) || '# **ANNEX III**' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'A. LABELLING' || chr(10) ELSE '' END || text || chr(10) || 'ANNEX IV' || chr(10) || lang"


@query(f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text ELSE {_ANNEXED} END AS x FROM documents),
s AS (SELECT doc_id, x, CASE WHEN regexp_matches(x, 'A\\.\\s*LABELLING') THEN regexp_extract(x, 'A\\.\\s*LABELLING', 0) WHEN regexp_matches(x, 'ANNEX\\s+III\\b') THEN regexp_extract(x, 'ANNEX\\s+III\\b', 0) END AS head FROM d),
r AS (SELECT doc_id, x, head, substr(x, strpos(x, head) + length(head)) AS rest FROM s),
e AS (SELECT doc_id, x, head || CASE WHEN regexp_matches(rest, 'ANNEX\\s+(?:I|II|IV|V)\\b') THEN left(rest, strpos(rest, regexp_extract(rest, 'ANNEX\\s+(?:I|II|IV|V)\\b', 0)) - 1) ELSE rest END AS part FROM r)
SELECT doc_id, md5(coalesce({_STRIP.format('part')}, x)) AS digest FROM e""")
def section_or_full(t: Catalog) -> DataFrame:
    annexed = F.concat(F.lit("see ANNEX I and Annex III\n# **ANNEX III**\n"), F.when(F.col("doc_id") % 2 == 0, F.lit("A. LABELLING\n")).otherwise(F.lit("")), F.col("text"), F.lit("\nANNEX IV\n"), F.col("lang"))
    x = t.table("documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.col("text")).otherwise(annexed).alias("x"))
    return x.select("doc_id", F.md5(text.section_or_full(F.col("x"), F.lit("European Union"))).alias("digest"))


@query("""
WITH c AS (SELECT id, greatest(1, length(coalesce(product_name, 'x')) // 4) + greatest(1, length(coalesce(document_text, 'x')) // 4) + 16 AS prompt FROM products),
a AS (SELECT id, 4096 - prompt - greatest(300, floor(prompt * 0.06)::BIGINT) AS left_over FROM c)
SELECT id, CASE WHEN left_over >= 512 THEN least(3072, left_over) END::VARCHAR AS reply FROM a""")
def reply_budget(t: Catalog) -> DataFrame:
    c = lambda name: F.coalesce(F.col(name), F.lit("x"))
    return t.table("products").select("id", text.reply_budget(c("product_name"), c("document_text"), F.lit(4096)).cast("string").alias("reply"))


@query("SELECT event_id, CASE WHEN value >= 3600 THEN printf('%dh%02dm', value::BIGINT // 3600, (value::BIGINT % 3600) // 60) WHEN trunc(value) >= 60 THEN printf('%dm%02ds', trunc(value)::BIGINT // 60, trunc(value)::BIGINT % 60) WHEN value <= -1 OR value IS NULL THEN '?' ELSE printf('%ds', trunc(value)::BIGINT) END AS shown FROM events")
def durations(t: Catalog) -> DataFrame:
    return t.table("events").select("event_id", text.duration(F.col("value")).alias("shown"))


# ---- JSON


@query("""
WITH x AS (SELECT id, feed, file_seq, crawled_at, unnest(json_keys(json_data)) AS k, json_data FROM (SELECT * FROM drug_predicate_raw_records QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawled_at, feed, file_seq) = 1)),
top AS (SELECT id, k AS path, json_extract(json_data, '$."' || k || '"') AS v FROM x),
two AS (SELECT id, path || '.' || k2 AS path, json_extract(v, '$."' || k2 || '"') AS v FROM (SELECT id, path, v, unnest(json_keys(v)) AS k2 FROM top WHERE json_type(v) = 'OBJECT')),
leaf AS (SELECT * FROM top WHERE json_type(v) <> 'OBJECT' UNION ALL SELECT * FROM two WHERE json_type(v) <> 'OBJECT')
SELECT id::BIGINT AS id, path, json_type(v) = 'ARRAY' AS is_list, CASE WHEN json_type(v) = 'ARRAY' THEN json_array_length(v)::VARCHAR ELSE v->>'$' END AS value
FROM leaf WHERE json_type(v) <> 'NULL' AND NOT (json_type(v) = 'ARRAY' AND json_array_length(v) = 0) AND coalesce(v->>'$', '') <> ''""")
def json_flatten(t: Catalog) -> DataFrame:
    once = promote.first_of(t.table("drug_predicate_raw_records").select("id", "crawled_at", "feed", "file_seq", "json_data"), ["id"], ["crawled_at", "feed", "file_seq"])
    leaves = jsonx.leaves(once, "id", "json_data")
    size = F.size(F.from_json("value", "array<string>")).cast("string")
    return leaves.select(long("id"), "path", "is_list", F.when(F.col("is_list"), size).otherwise(F.col("value")).alias("value"))


@query()
def json_pack_units(t: Catalog) -> DataFrame:
    once = promote.first_of(t.table("drug_predicate_raw_records").select("id", "crawled_at", "feed", "file_seq", "json_data"), ["id"], ["crawled_at", "feed", "file_seq"])
    return fold.size_of_units(jsonx.json_units(once, "id", "json_data", SMALL))


@query("SELECT id, product_data IS NOT NULL AS parsed, length(product_data)::BIGINT AS n FROM products")
def json_repair(t: Catalog) -> DataFrame:
    # a reply with words around it and a stray comma before its last brace
    damaged = F.concat(F.lit("Here is the result:\n```json\n"), F.expr("substring(product_data, 1, length(product_data) - 1)"), F.lit(",}\n```"))
    return t.table("products").select("id", jsonx.parse_reply(damaged).isNotNull().alias("parsed"), F.length(jsonx.parse_reply(damaged)).cast("long").alias("n"))


@query("""
WITH x AS (SELECT count(*) AS total FROM products), keys AS (SELECT unnest(['substance', 'presentations', 'indications', 'approval', 'pivotal_evidence', 'key_risks', 'excipients']) AS key_name)
SELECT key_name, count(*) FILTER (WHERE list_contains(json_keys(product_data), key_name)) AS present,
  count(*) FILTER (WHERE json_type(product_data, '$.' || key_name) <> 'NULL' AND json_extract_string(product_data, '$.' || key_name) NOT IN ('', '[]', '{}')) AS filled FROM products, keys GROUP BY key_name""")
def document_coverage(t: Catalog) -> DataFrame:
    return tables.coverage(t.table("products"), "product_data", list(fold.DOCUMENT_KEYS))


# ---- mappers


@query(r"""
WITH s AS (SELECT id, unnest(strengths) AS s FROM products), m AS (SELECT id, s, regexp_extract(s, '(?i)^\s*(?:EQ\s+)?([\d.,]+)\s*(%|[A-Za-z/]+)(?:\s+([A-Z]+))?(?:\s*/\s*([\d.,]*)\s*([A-Za-z%]+))?\s*$', ['v', 'u', 'b', 'pv', 'pu']) AS g FROM s)
SELECT id, s, try_cast(replace(g.v, ',', '') AS DOUBLE) AS value,
  nullif(CASE upper(g.u) WHEN 'MG' THEN 'mg' WHEN 'IU' THEN 'IU' WHEN 'MMOL' THEN 'mmol' WHEN 'G' THEN 'g' WHEN 'MCG' THEN 'mcg' ELSE lower(g.u) END, '') AS unit FROM m""")
def strength_parse(t: Catalog) -> DataFrame:
    s = t.table("products").select("id", F.explode("strengths").alias("s")).withColumn("p", common.parse_strength(F.col("s")))
    return s.select("id", "s", F.col("p.value").alias("value"), F.col("p.unit").alias("unit"))


def _salt_sql() -> str:
    salts = "[" + ", ".join(f"'{s}'" for s in common.SALTS) + "]"
    step = f"list_filter({salts}, lambda s: ends_with(x, ' ' || s) AND NOT list_contains({salts}, trim(left(x, greatest(length(x) - length(s) - 1, 0)))))[1]"
    peel = lambda source: f"SELECT id, low, CASE WHEN t IS NULL THEN x ELSE trim(left(x, length(x) - length(t) - 1)) END AS x FROM (SELECT id, low, x, {step} AS t FROM {source})"
    clean = r"nullif(regexp_replace(regexp_replace(generic_name, '\s+', ' ', 'g'), '^[ ;,]+|[ ;,]+$', '', 'g'), '')"
    title = lambda x: f"upper(left({x}, 1)) || substr({x}, 2)"
    return f"""WITH p0 AS (SELECT id, lower({clean}) AS low, lower({clean}) AS x FROM products), p1 AS ({peel('p0')}), p2 AS ({peel('p1')}), p3 AS ({peel('p2')}), p4 AS ({peel('p3')})
    SELECT id, {title('x')} AS base, CASE WHEN x <> low THEN {title('low')} END AS salt FROM p4"""


@query(_salt_sql())
def salt_strip(t: Catalog) -> DataFrame:
    return t.table("products").select("id", common.base_substance(F.col("generic_name")).alias("s")).select("id", "s.base", "s.salt")


def _area_sql() -> str:
    values = lambda table: ", ".join(f"('{k}', '{v}')" for k, v in table.items())
    return f"""WITH a(k, v) AS (VALUES {values(sa.AREA_BY_PREFIX)}), b(k, v) AS (VALUES {values(sa.AREA_BY_LETTER)})
    SELECT p.id, coalesce(a.v, b.v) AS area FROM products p LEFT JOIN a ON a.k = left(upper(trim(p.atc_code)), 3) LEFT JOIN b ON b.k = left(upper(trim(p.atc_code)), 1)"""


@query(_area_sql())
def atc_area(t: Catalog) -> DataFrame:
    return t.table("products").select("id", sa.area(F.col("atc_code")).alias("area"))


_CLEAN = r"nullif(regexp_replace(regexp_replace(json_extract_string(json_data, '$.{}'), '\s+', ' ', 'g'), '^[ ;,]+|[ ;,]+$', '', 'g'), '')"


@query(rf"""
SELECT id, {_CLEAN.format('trade_name')} AS brand_name, {_CLEAN.format('marketing_company')} AS mah_name, {_CLEAN.format('registration_number')} AS registration_number,
  CASE WHEN lower(trim(json_extract_string(json_data, '$.authorization_status'))) = 'valid' THEN 'Active' END AS status,
  nullif(lower(regexp_replace({_CLEAN.format('administration_route')}, '(?i)\s+use\s*$', '')), '') AS route
FROM products WHERE regulator = 'SFDA'""")
def mapper_sa_columns(t: Catalog) -> DataFrame:
    mapped = sa.extract(t.table("products").where("regulator = 'SFDA'").select("id", "json_data"))
    return mapped.select("id", "columns.brand_name", "columns.mah_name", "columns.registration_number", "columns.status", F.try_element_at("columns.routes", F.lit(1)).alias("route"))


@query(rf"""
WITH r AS (SELECT id, json_data AS j FROM products WHERE regulator = 'SFDA' AND json_valid(json_data))
SELECT id, {_STRIP.format("j->>'$.trade_name'")} AS brand_name, {_STRIP.format("j->>'$.registration_number'")} AS registration_number,
  CASE j->>'$.drug_type' WHEN 'NCE' THEN 'New Chemical Entity' ELSE j->>'$.drug_type' END AS product_type, CASE WHEN lower({_STRIP.format("j->>'$.authorization_status'")}) = 'valid' THEN 'Active' END AS status,
  CASE j->>'$.drug_type' WHEN 'Generic' THEN 'true' WHEN 'NCE' THEN 'false' END AS is_generic, 'en' AS source_language, CAST(NULL AS VARCHAR) AS approval_date FROM r""")
def sa_columns(t: Catalog) -> DataFrame:
    # records without valid JSON have no row, and names and numbers stay as written but for outer blanks (mapper_sa_columns has them cleaned)
    records = jsonx.standard_records(t.table("products").where("regulator = 'SFDA'"), "id", "json_data")
    done = sa.extract(records.withColumn("_raw", F.from_json("json_data", "trade_name string, registration_number string")))
    return done.select(
        "id", text.strip(F.col("_raw.trade_name")).alias("brand_name"), text.strip(F.col("_raw.registration_number")).alias("registration_number"),
        *[F.col(f"columns.{c}").alias(c) for c in ("product_type", "status", "source_language")], F.col("columns.is_generic").cast("string").alias("is_generic"), F.col("columns.approval_date").cast("string").alias("approval_date"),
    )


@query()
def mapper_registers(t: Catalog) -> DataFrame:
    return pipeline.map_registers(t.table("products"))


@query(rf"""
WITH c AS (SELECT id, unnest(from_json(json_extract(json_data, '$.components'), '["JSON"]')) AS c FROM products WHERE regulator = 'TGA' AND json_type(json_data, '$.components') = 'ARRAY'),
s AS (SELECT id, unnest(string_split(c->>'$.pack_size', ',')) AS p FROM c),
q AS (SELECT DISTINCT id, {_STRIP.format(r"regexp_replace(p, '\s*\([^)]*\)\s*$', '')")} AS p FROM s)
SELECT DISTINCT id, regexp_extract(p, '(\d+)', 1)::DOUBLE AS size, nullif(lower(regexp_extract(p, '(?i)^(?:pack\s+of\s+)?\d+\s*(?:''|’)?({'|'.join(au.PACK_WORDS)})?', 1)), '') AS unit
FROM q WHERE NOT contains(lower(p), 'x') AND regexp_matches(p, '(?i)^(?:pack\s+of\s+)?(\d+)\s*(?:''|’)?(?:({'|'.join(au.PACK_WORDS)})s?)?(?:\s+pack)?$')""")
def pack_sizes(t: Catalog) -> DataFrame:
    c = t.table("products").where("regulator = 'TGA'").select("id", F.explode(F.from_json(F.get_json_object("json_data", "$.components"), "array<struct<pack_size: string>>")).alias("c"))
    return c.select("id", F.explode(au.pack_sizes(F.col("c.pack_size"))).alias("p")).select("id", "p.size", "p.unit").distinct()


@query(r"""
WITH c AS (SELECT id, unnest(from_json(json_extract(json_data, '$.components'), '["JSON"]')) AS c, generate_subscripts(from_json(json_extract(json_data, '$.components'), '["JSON"]'), 1) AS n FROM products WHERE regulator = 'TGA' AND json_type(json_data, '$.components') = 'ARRAY'),
flat AS (SELECT id, n, regexp_replace(c->>'$.active_ingredients', '\([^)]*\)', '', 'g') AS t FROM c)
SELECT id, n::BIGINT AS component_no, len(list_filter(list_transform(string_split(t, ';'), lambda x: trim(x)), lambda x: x <> ''))::BIGINT AS n_ingredients FROM flat WHERE t IS NOT NULL""")
def toplevel_split(t: Catalog) -> DataFrame:
    c = t.table("products").where("regulator = 'TGA'").select("id", F.posexplode(F.from_json(F.get_json_object("json_data", "$.components"), "array<struct<active_ingredients: string>>")).alias("i", "c"))
    return c.where("c.active_ingredients is not null").select("id", (F.col("i") + 1).cast("long").alias("component_no"), F.size(text.split_top_level(F.col("c.active_ingredients"))).cast("long").alias("n_ingredients"))


@query()
def us_history(t: Catalog) -> DataFrame:
    j = t.table("products").where("regulator = 'FDA'").select("id", F.from_json("json_data", us.SCHEMA).alias("j"))
    return j.select("id", F.explode(us.history(F.col("j"))).alias("h")).select("id", F.col("h.date").cast("string").alias("date"), "h.submission", "h.priority")


# ---- folds and excerpts


@query("""
WITH once AS (SELECT product_id, chunk_index, min(chunk_text) AS t FROM product_chunks GROUP BY ALL)
SELECT product_id, count(*) AS n_chunks, md5(string_agg(t, chr(10) ORDER BY chunk_index)) AS digest FROM once GROUP BY product_id""")
def ordered_fold(t: Catalog) -> DataFrame:
    return fold.reading_order(t.table("product_chunks")).select("product_id", "n_chunks", F.md5("text").alias("digest"))


@query()
def folded_registers(t: Catalog) -> DataFrame:
    done = pipeline.fold_registers(t.table("products"), t.table("product_chunks").select("product_id", "chunk_index", "chunk_text").distinct())
    return done.select("id", long("n_excerpts"), "complete", F.md5("product_data").alias("digest"))


@query()
def repaired_rows(t: Catalog) -> DataFrame:
    return repair.repaired(t.table("products")).select("id", F.md5("product_data").alias("digest"), "error")


@query()
def model_fold(t: Catalog) -> DataFrame:
    products = t.table("products")
    units = jsonx.json_units(products.select("id", "json_data"), "id", "json_data")
    stated = products.select("id", F.lit(0).alias("seq"), F.col("product_data").alias("unit")).where("unit is not null")
    return fold.fold_products(stated.unionByName(units.select("id", (F.col("seq") + 1).alias("seq"), "unit"))).select("id", long("n_excerpts"), "complete", F.md5("product_data").alias("digest"))


_DOC_TYPE = "list_filter(from_json(json_extract(json_data, '$.documents'), '[{{\"s3_path\": \"VARCHAR\", \"doc_type\": \"VARCHAR\", \"document_type\": \"VARCHAR\"}}]'), lambda d: d.s3_path = {})"


@query(f"SELECT id, feed, file_seq::BIGINT AS file_seq, ({_DOC_TYPE.format('document_url[1]')})[1].document_type AS document_type FROM drug_predicate_raw_records")
def doc_type_lookup(t: Catalog) -> DataFrame:
    r = t.table("drug_predicate_raw_records")
    return r.select("id", "feed", long("file_seq"), fold.primary_document_type(F.col("json_data"), F.try_element_at("document_url", F.lit(1))).alias("document_type"))


@query(f"""
WITH r AS (SELECT id, feed, file_seq, document_url[1] AS src, {_DOC_TYPE.format('document_url[1]')} AS own,
  list_filter(from_json(json_extract(json_data, '$.documents'), '[{{"s3_path": "VARCHAR", "doc_type": "VARCHAR", "document_type": "VARCHAR"}}]'), lambda d: d.doc_type = 'PIL' AND d.s3_path <> '' AND d.s3_path IS DISTINCT FROM document_url[1]) AS other
  FROM drug_predicate_raw_records WHERE country_id = 4)
SELECT id, feed, file_seq::BIGINT AS file_seq, src AS first_path, own[1].doc_type AS first_type, CASE WHEN own[1].doc_type IS DISTINCT FROM 'PIL' THEN other[1].s3_path END AS second_path FROM r""")
def doc_selection(t: Catalog) -> DataFrame:
    r = t.table("drug_predicate_raw_records").where("country_id = 4")
    chosen = docs.selected_documents(F.col("json_data"), F.try_element_at("document_url", F.lit(1)), F.lit("United Kingdom"))
    s = r.select("id", "feed", long("file_seq"), chosen.alias("d"))
    return s.select("id", "feed", "file_seq", F.col("d")[0]["path"].alias("first_path"), F.col("d")[0]["doc_type"].alias("first_type"), F.try_element_at("d", F.lit(2))["path"].alias("second_path"))


@query("SELECT event_type AS provider, count(*) AS calls, sum(user_id)::BIGINT AS prompt_tokens, sum(event_id)::BIGINT AS completion_tokens, round(sum(value), 2) AS cost FROM events GROUP BY event_type")
def usage_totals(t: Catalog) -> DataFrame:
    calls = t.table("events").select(F.col("event_type").alias("provider"), F.col("user_id").alias("prompt_tokens"), F.col("event_id").alias("completion_tokens"), F.col("value").alias("cost"))
    return fold.usage_totals(calls).withColumn("cost", F.round("cost", 2))


# ---- tables


@query("""
WITH new AS (SELECT id, product_id, chunk_index, upper(chunk_text) AS chunk_text FROM product_chunks WHERE doc_type = 'PIL')
SELECT id::BIGINT AS id, product_id, chunk_index::BIGINT AS chunk_index, md5(chunk_text) AS digest FROM (SELECT id, product_id, chunk_index, chunk_text FROM product_chunks o ANTI JOIN new n ON n.product_id = o.product_id UNION ALL SELECT * FROM new)""")
def chunk_replace(t: Catalog) -> DataFrame:
    old = t.table("product_chunks").select("id", "product_id", "chunk_index", "chunk_text", "doc_type")
    new = old.where("doc_type = 'PIL'").withColumn("chunk_text", F.upper("chunk_text"))
    out = tables.replace_by_key(old, new, "product_id")
    return out.select(long("id"), "product_id", long("chunk_index"), F.md5("chunk_text").alias("digest"))


@query("SELECT c.id::BIGINT AS id, c.product_id FROM product_chunks c ANTI JOIN (SELECT id FROM products WHERE regulator = 'MHRA') p ON p.id = c.product_id")
def targeted_delete(t: Catalog) -> DataFrame:
    return tables.delete_where(t.table("product_chunks"), t.table("products").where("regulator = 'MHRA'").select(F.col("id").alias("product_id")), "product_id").select(long("id"), "product_id")


@query("""
WITH w AS (SELECT p.id, p.country_id, r.want FROM products p JOIN (SELECT id, coalesce(registration_number, 'X' || raw_record_id % 7) AS want FROM products WHERE NOT is_active OR registration_number IS NULL) r ON r.id = p.id WHERE r.want IS NOT NULL),
h AS (SELECT w.id, w.country_id, w.want, EXISTS (SELECT 1 FROM products o WHERE o.country_id IS NOT DISTINCT FROM w.country_id AND o.registration_number = w.want AND o.id <> w.id) AS held FROM w),
f AS (SELECT country_id, want, min(id) AS first FROM h WHERE NOT held GROUP BY ALL)
SELECT h.id, CASE WHEN NOT held AND f.first = h.id THEN h.want END AS registration_number FROM h LEFT JOIN f ON f.country_id IS NOT DISTINCT FROM h.country_id AND f.want = h.want""")
def persist_guard(t: Catalog) -> DataFrame:
    p = t.table("products")
    proposals = p.where("not is_active or registration_number is null").select("id", F.coalesce("registration_number", F.concat(F.lit("X"), F.col("raw_record_id") % 7)).alias("registration_number"))
    return tables.guard_unique(p, proposals, "id", "country_id", "registration_number")


_CHANGED = "SELECT id, mah_name, upper(status) AS status, CASE WHEN raw_record_id % 3 = 0 THEN NULL ELSE atc_code END AS atc_code FROM products WHERE raw_record_id % 10 <> 0"


@query(f"""
WITH l AS (SELECT id, mah_name, status, atc_code FROM products), r AS ({_CHANGED}),
b AS (SELECT coalesce(l.id, r.id) AS id, l.mah_name AS lm, r.mah_name AS rm, l.status AS ls, r.status AS rs, l.atc_code AS la, r.atc_code AS ra FROM l FULL JOIN r ON l.id = r.id)
SELECT * FROM (SELECT id, 'mah_name' AS column_name, lm AS left_value, rm AS right_value FROM b UNION ALL SELECT id, 'status', ls, rs FROM b UNION ALL SELECT id, 'atc_code', la, ra FROM b) WHERE left_value IS DISTINCT FROM right_value""")
def diff_columns(t: Catalog) -> DataFrame:
    p = t.table("products")
    changed = p.where("raw_record_id % 10 <> 0").select("id", "mah_name", F.upper("status").alias("status"), F.when(F.col("raw_record_id") % 3 != 0, F.col("atc_code")).alias("atc_code"))
    return tables.diff_columns(p.select("id", "mah_name", "status", "atc_code"), changed, "id", ["mah_name", "status", "atc_code"])


@query("""
WITH s AS (SELECT id, list_distinct(coalesce(adverse_reactions, [])) AS a, list_distinct(coalesce(symptoms, [])) AS b FROM products),
d AS (SELECT id, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS l, list_sort(list_filter(b, lambda x: NOT list_contains(a, x))) AS r FROM s)
SELECT id, array_to_string(l, '|') AS only_left, array_to_string(r, '|') AS only_right FROM d WHERE len(l) > 0 OR len(r) > 0""")
def diff_sets(t: Catalog) -> DataFrame:
    p = t.table("products")
    out = tables.diff_sets(p.select("id", F.col("adverse_reactions").alias("x")), p.select("id", F.col("symptoms").alias("x")), "id", "x")
    return out.select("id", F.array_join("only_left", "|").alias("only_left"), F.array_join("only_right", "|").alias("only_right"))


@query("SELECT processing_status, text_extraction_status, ai_extraction_status, count(*) AS n, count(*) FILTER (WHERE document_text IS NOT NULL) AS with_text FROM products GROUP BY ALL")
def outcome_counts(t: Catalog) -> DataFrame:
    return t.table("products").groupBy("processing_status", "text_extraction_status", "ai_extraction_status").agg(F.count("*").alias("n"), F.count("document_text").alias("with_text"))


@query("SELECT p.id, count(c.id) AS n_chunks FROM products p LEFT JOIN product_chunks c ON c.product_id = p.id GROUP BY p.id ORDER BY n_chunks DESC, p.id LIMIT 50")
def top_products_by_chunks(t: Catalog) -> DataFrame:
    counts = t.table("product_chunks").groupBy(F.col("product_id").alias("id")).agg(F.count("*").alias("n"))
    joined = t.table("products").select("id").join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n_chunks"))
    return joined.orderBy(F.desc("n_chunks"), "id").limit(50)


# ---- repair

_STORED = "CASE json_type(s) WHEN 'ARRAY' THEN from_json(s, '[\"JSON\"]') WHEN 'OBJECT' THEN [s] END"
_REPAIR = f"""
x AS (SELECT id, json_data, json_extract(json_data, '$.components') AS comps, try_cast(json_extract_string(product_data, '$.presentations') AS JSON) AS s FROM products WHERE list_contains(json_keys(json_data), 'artg_id')),
y AS (SELECT id, json_data, from_json(comps, '["JSON"]') AS c, {_STORED} AS p FROM x),
chosen AS (SELECT id, len(c)::BIGINT AS n_components, len(p)::BIGINT AS n_presentations, length(json_data)::BIGINT AS chars FROM y
  WHERE len(list_filter(c, lambda k: trim(coalesce(k->>'$.pack_size', '')) <> '')) > 0
    AND (len(list_filter(p, lambda q: (q->>'$.pack_size') IS NULL)) > 0 OR (len(p) = 1 AND len(list_filter(c, lambda k: contains(k->>'$.pack_size', ','))) > 0)))"""


@query(f"WITH {_REPAIR} SELECT * FROM chosen")
def repair_candidates(t: Catalog) -> DataFrame:
    return repair.candidates(t.table("products")).select("id", long("n_components"), long("n_presentations"), long("chars"))


@query(f"WITH {_REPAIR} SELECT count(*) AS records, count(*) FILTER (WHERE n_components = 1) AS single, round(avg(chars) FILTER (WHERE n_components = 1), 2) AS mean_chars, max(chars) FILTER (WHERE n_components = 1) AS max_chars FROM chosen")
def repair_cost(t: Catalog) -> DataFrame:
    c = repair.cost(repair.candidates(t.table("products")))
    return c.select("records", "single", "mean_chars", long("max_chars"))


@query(r"""
WITH n AS (SELECT doc_id, text, lower(trim(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g'))) AS raw, CASE WHEN doc_id % 3 = 0 THEN ['zz not there', substr(text, 1, 40)] ELSE [substr(text, 5, 40), upper(substr(text, 20, 30))] END AS r FROM documents),
k AS (SELECT doc_id, raw, list_filter(list_transform(r, lambda x: regexp_replace(x, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), lambda x: x <> '') AS r FROM n)
SELECT doc_id, raw <> '' AND len(list_filter(r, lambda x: NOT contains(raw, lower(trim(regexp_replace(x, '[\s\p{Z}]+', ' ', 'g')))))) = 0 AS accepted FROM k""")
def validate_substring(t: Catalog) -> DataFrame:
    x = F.col("text")
    returned = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("zz not there"), F.substring(x, 1, 40))).otherwise(F.array(F.substring(x, 5, 40), F.upper(F.substring(x, 20, 30))))
    return t.table("documents").select("doc_id", repair.checked_indications(x, returned).isNotNull().alias("accepted"))


# ---- increments


@query("SELECT id::BIGINT AS id, feed, file_seq::BIGINT AS file_seq FROM drug_predicate_raw_records QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawled_at, feed, file_seq) = 1")
def incremental_dedupe(t: Catalog) -> DataFrame:
    """The raw records taken in by a stream over the table's files, each id once; run twice, the second time adds nothing."""
    import uuid

    spark = t.spark
    folder = f"{ensure_checkpoint_dir(spark)}/incremental-{uuid.uuid4().hex}"
    schema = t.table("drug_predicate_raw_records").schema
    for _ in range(2):
        stream = incremental.file_stream(spark, t.path("drug_predicate_raw_records") + "*", schema)
        incremental.run_available(stream, incremental.append_new(spark, "id", ["crawled_at", "feed", "file_seq"], f"{folder}/out"), f"{folder}/progress")
    return spark.read.parquet(f"{folder}/out").select(long("id"), "feed", long("file_seq"))


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_per_day(t: Catalog) -> DataFrame:
    return incremental.events_per_window(t.table("events"))
