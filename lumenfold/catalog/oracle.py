"""The queries of the catalog as SQL on the same tables."""

from __future__ import annotations

from lumenfold.functions import text

FEATURES = ["completions", "population", "high_school", "some_college", "bachelor", "unemployment"]
# The token pattern, quoted for SQL.
TOKEN = text.TOKEN.replace("'", "''").replace("\\''", "''")
# White space as Unicode defines it, with the four separator control characters.
SPACE = (
    r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

REVIEWS = """
reviews AS (
  SELECT d.doc_id, d.text, l.doc_id IS NOT NULL AS whole, COALESCE(CAST(l.quality AS DOUBLE), 0) AS y,
         COALESCE(CAST(l.toxic AS DOUBLE), 0) AS c
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""
TOKENS = f"""{REVIEWS},
tokens AS (
  SELECT doc_id, whole, y, c, len(ts) AS length, unnest(ts) AS token
  FROM (SELECT doc_id, whole, y, c, regexp_extract_all(text, '{TOKEN}', 1) AS ts FROM reviews)
),
top AS (
  SELECT lower(token) AS word, COUNT(*) AS n FROM tokens GROUP BY 1 ORDER BY n DESC, word LIMIT 1000
),
freqs AS (
  SELECT t.doc_id, lower(t.token) AS word, any_value(t.y) AS y, any_value(t.c) AS c, any_value(t.whole) AS whole,
         CAST(COUNT(*) AS DOUBLE) / any_value(t.length) AS frequency
  FROM tokens t JOIN top ON lower(t.token) = top.word
  GROUP BY t.doc_id, lower(t.token) HAVING bool_or(t.token = lower(t.token))
)"""

# Two-sided Student-t tail by Simpson's rule, for a table `tested` with t and df.
P_VALUE = """
nodes AS (
  SELECT i * 12.0::DOUBLE / 20000 AS q, CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
  FROM range(20001) r(i)
),
p_values AS (
  SELECT key, 2 * exp(lgamma((df + 1) / 2.0::DOUBLE) - lgamma(df / 2.0::DOUBLE) - df / 2.0::DOUBLE * ln(1 + t * t / df))
         / sqrt(pi()) / df * SUM(w * 2 * q * exp(-q * q)
           / sqrt(1 - exp(-2 * q * q / df) / (1 + t * t / df))) * 12.0::DOUBLE / 20000 / 3 AS p
  FROM tested, nodes WHERE abs(t) > 0 AND NOT isinf(t) GROUP BY key, t, df
  UNION ALL SELECT key, 0.0 FROM tested WHERE isinf(t)
)"""

CELLS = """
cells AS (
  SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS BIGINT) AS year,
         SUM(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS completions,
         SUM(l_quantity) * 2.5::DOUBLE AS population,
         AVG(l_discount) * 600.0::DOUBLE AS high_school,
         AVG(l_tax) * 750.0::DOUBLE AS some_college,
         AVG(l_quantity) * 0.8::DOUBLE AS bachelor,
         AVG(l_extendedprice) / 1000.0::DOUBLE AS unemployment
  FROM lineitem GROUP BY 1, 2
)"""


def _index(share: str) -> str:
    return f"({share} + 0.4::DOUBLE * high_school + 0.6::DOUBLE * some_college + 0.8::DOUBLE * bachelor) / 100.0::DOUBLE"


OPEN_SHARE = "completions * 100.0::DOUBLE / population"
CAPPED_SHARE = f"CASE WHEN {OPEN_SHARE} > 0.493279::DOUBLE THEN 0.493279::DOUBLE ELSE {OPEN_SHARE} END"
INDEXED = f"""{CELLS},
indexed AS (SELECT *, {_index('share')} AS "index" FROM (SELECT *, {CAPPED_SHARE} AS share FROM cells))"""

PLACES = f"""
places AS (
  SELECT place, line, year,
    CASE WHEN k % 23 <> 0 THEN lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '-0001' END AS zip_text, l_suppkey,
    CASE WHEN k % 29 = 0 THEN 'PrivacySuppressed'
         WHEN k % 43 = 0 THEN ['12N', '40N', '1n2', 'N5', '5d', '1e999', 'Infinity'][k % 7 + 1] WHEN k % 31 <> 0 THEN format('{{:,}}', v) END AS completions,
    CASE WHEN k % 37 = 0 THEN '' ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END AS tuition,
    CASE WHEN k % 3 <> 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS loans,
    CASE WHEN k % 2 <> 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS rare
  FROM (SELECT l_orderkey AS place, l_linenumber AS line, CAST(year(l_shipdate) AS BIGINT) AS year, *,
               l_orderkey * 7 + l_linenumber AS k, CAST(round(l_extendedprice) AS BIGINT) AS v FROM lineitem)
)"""
NUMBERS = """
numbers AS (
  SELECT place, line, year, zip_text, l_suppkey,
         CASE WHEN regexp_full_match(replace(completions, ',', ''), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')
              AND NOT isinf(TRY_CAST(replace(completions, ',', '') AS DOUBLE))
              THEN TRY_CAST(replace(completions, ',', '') AS DOUBLE) END AS completions, TRY_CAST(tuition AS DOUBLE) AS tuition,
         TRY_CAST(loans AS DOUBLE) AS loans, TRY_CAST(rare AS DOUBLE) AS rare
  FROM places
)"""
ZIP_MAP = """
zip_map AS (
  SELECT s_suppkey AS zip, s_suppkey AS entity FROM supplier
  UNION SELECT s_suppkey // 2, s_suppkey FROM supplier
)"""
EXTERNAL = f"""{CELLS},
joined AS (
  SELECT entity, year, unemployment, high_school, some_college,
         CASE WHEN (entity + year) % 11 <> 0 THEN bachelor END AS bachelor,
         CASE WHEN (entity * 3 + year) % 13 <> 0 THEN floor(population) END AS population
  FROM cells
),
filled AS (
  SELECT entity, year, unemployment, high_school, some_college,
         COALESCE(bachelor, (SELECT AVG(high_school) FROM joined)) AS bachelor,
         COALESCE(population, (SELECT MAX(population) FROM joined)) AS population
  FROM joined
)"""

RATINGS = """
ratings AS (
  SELECT "user", item, rating FROM (
    SELECT o_custkey AS "user", l_partkey AS item, l_quantity AS rating,
           row_number() OVER (PARTITION BY o_custkey, l_partkey
             ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, l_shipdate DESC, l_quantity DESC) AS place
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE place = 1
)"""
SUPPORTED = f"""{RATINGS},
of_items AS (SELECT * FROM ratings WHERE item IN (SELECT item FROM ratings GROUP BY item HAVING COUNT(*) >= 25)),
supported AS (
  SELECT * FROM of_items WHERE "user" IN (SELECT "user" FROM of_items GROUP BY "user" HAVING COUNT(*) >= 5)
)"""
NEIGHBOURS = f"""{SUPPORTED},
centred AS (SELECT "user", item, rating - AVG(rating) OVER (PARTITION BY item) AS d FROM supported),
norms AS (SELECT item, sqrt(SUM(d * d)) AS norm FROM centred GROUP BY item),
targets AS (SELECT DISTINCT item AS target FROM supported ORDER BY item LIMIT 2),
dots AS (
  SELECT t.item AS target, o.item AS item, SUM(t.d * o.d) AS dot
  FROM centred t JOIN centred o ON t."user" = o."user"
  WHERE t.item IN (SELECT target FROM targets) GROUP BY 1, 2 HAVING COUNT(*) >= 2
),
scored AS (
  SELECT target, dots.item, dot / (nt.norm * ni.norm) AS similarity
  FROM dots JOIN norms nt ON nt.item = target JOIN norms ni ON ni.item = dots.item
  WHERE nt.norm * ni.norm > 0 AND dot / (nt.norm * ni.norm) > 1e-12
),
neighbours AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY target ORDER BY round(similarity, 9) DESC, item) AS INTEGER) AS rank FROM scored) WHERE rank <= 50
)"""


def _places(source: str, features: list[str], size: str = "1.0::DOUBLE") -> str:
    """(entity, place, value) of vectors with the features in this order; those of size 0 have none."""
    return " UNION ALL ".join(
        f"SELECT entity, {p} AS place, round({_quoted(f)} / {size}, 6) AS value FROM {source} WHERE {size} > 0"
        for p, f in enumerate(features)
    )


GAPS = """REPLACE (CASE WHEN entity % 5 > 1 THEN bachelor END AS bachelor,
CASE WHEN entity % 11 > 0 THEN high_school END AS high_school)"""


def _scaled(mode: str, gaps: str = "") -> str:
    low, high = (
        ("min_by({f}, entity) FILTER (WHERE {f} IS NOT NULL)", "max_by({f}, entity) FILTER (WHERE {f} IS NOT NULL)")
    ) if mode == "endpoint" else ("min({f})", "max({f})")
    parts = []
    for f in FEATURES:
        lo, hi = f"(SELECT {low.format(f=f)} FROM one_year)", f"(SELECT {high.format(f=f)} FROM one_year)"
        parts.append(f"CASE WHEN {f} IS NOT NULL AND {hi} = {lo} THEN 0.0::DOUBLE ELSE ({f} - {lo}) / ({hi} - {lo}) + 0.0::DOUBLE END AS {f}")
    return f"""{CELLS},
one_year AS (SELECT * {gaps} FROM cells WHERE year = 1998),
scaled AS (SELECT entity, {', '.join(parts)} FROM one_year)"""


def _long(source: str, keys: str, features: list[str], value: str = "{f}") -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{f}' AS feature, round({value.format(f=_quoted(f))}, 6) AS value FROM {source}" for f in features
    )


def _quoted(name: str) -> str:
    return f'"{name}"'


_DOT = " + ".join(f"a.{f} * b.{f}" for f in FEATURES)
COSINES = f"""{_scaled('endpoint')},
sized AS (SELECT *, sqrt({' + '.join(f'{f} * {f}' for f in FEATURES)}) AS size FROM scaled),
vectors AS (SELECT * FROM sized WHERE size > 0),
cosines AS (
  SELECT a.entity AS a, b.entity AS b, ({_DOT}) / (a.size * b.size) AS similarity
  FROM vectors a JOIN vectors b ON a.entity < b.entity
)"""


def _neighbour_lists(asked: str) -> str:
    return f"""WITH {COSINES},
asked AS (
  SELECT a.entity AS query, b.entity AS entity, ({_DOT}) / (a.size * b.size) AS similarity
  FROM vectors a, vectors b {asked}
)
SELECT query, entity, round(similarity, 6) AS similarity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY round(similarity, 9) DESC, entity) AS INTEGER) AS rank
  FROM asked WHERE similarity > 1e-12) WHERE rank <= 50"""


def _both_ends(source: str, key: str, columns: str, k: int, score: str) -> str:
    return f"""
SELECT * FROM (SELECT {columns}, 'top' AS side FROM {source} WHERE {score} IS NOT NULL AND NOT isnan({score})
  ORDER BY round({score}, 9) DESC, {key} LIMIT {k})
UNION ALL
SELECT * FROM (SELECT {columns}, 'bottom' AS side FROM {source} WHERE {score} IS NOT NULL AND NOT isnan({score})
  ORDER BY round({score}, 9), {key} LIMIT {k})"""


_WHOLE = """
whole AS (SELECT COUNT(*) AS n, AVG(y) AS my, AVG(c) AS mc, stddev_pop(y) AS sy, stddev_pop(c) AS sc,
                 AVG(y * c) - AVG(y) * AVG(c) AS cyc FROM reviews),
sums AS (
  SELECT f.word, any_value(w.n) AS n, SUM(f.frequency) / any_value(w.n) AS mx,
         sqrt(SUM(f.frequency * f.frequency) / any_value(w.n) - (SUM(f.frequency) / any_value(w.n)) ** 2) AS sx,
         SUM(f.frequency * (f.y - w.my)) / any_value(w.n) AS cxy, SUM(f.frequency * (f.c - w.mc)) / any_value(w.n) AS cxc
  FROM freqs f, whole w WHERE f.whole GROUP BY f.word
)"""
_WORD_OUTPUT = f"""
scored AS (
  SELECT s.key AS word, s.beta, p.p * 1000 AS p, s.n FROM tested s JOIN p_values p ON s.key = p.key
)
{_both_ends('scored', 'word', 'word, round(beta, 6) AS beta, round(p, 6) AS p, n', 20, 'beta')}"""

WORD_REGRESSION = f"""WITH {TOKENS}, {_WHOLE},
tested AS (
  SELECT word AS key, r AS beta, r * sqrt(n - 2) / sqrt(1 - r * r) AS t, n - 2 AS df, n
  FROM (SELECT word, s.n, cxy / (sx * sy) AS r FROM sums s, whole)
), {P_VALUE}, {_WORD_OUTPUT}"""

WORD_REGRESSION_CONTROLLED = f"""WITH {TOKENS}, {_WHOLE},
correlations AS (
  SELECT word, s.n, cxy / (sx * sy) AS r1, cyc / (sy * sc) AS r2, cxc / (sx * sc) AS r12 FROM sums s, whole
),
slopes AS (
  SELECT *, (r1 - r2 * r12) / (1 - r12 * r12) AS b1, (r2 - r1 * r12) / (1 - r12 * r12) AS b2 FROM correlations
),
tested AS (
  SELECT word AS key, b1 AS beta, b1 * sqrt(n - 3) / sqrt(1 - b1 * r1 - b2 * r2) AS t, n - 3 AS df, n FROM slopes
), {P_VALUE}, {_WORD_OUTPUT}"""

WORD_REGRESSION_DROP = WORD_REGRESSION.replace("AS cyc FROM reviews)", "AS cyc FROM reviews WHERE whole)")
WORD_REGRESSION_OLS = (
    WORD_REGRESSION_CONTROLLED.replace("sqrt(1 - b1 * r1 - b2 * r2)", "sqrt((1 - b1 * r1 - b2 * r2) / (1 - r12 * r12))")
    .replace("p.p * 1000 AS p", "least(p.p * 1000, 1) AS p")
    .replace("HAVING bool_or(t.token = lower(t.token))", "")
)

_REGRESSED = [*FEATURES, "share", "index"]
FEATURE_REGRESSION = f"""WITH {INDEXED},
long AS ({' UNION ALL '.join(f'''SELECT '{f}' AS feature, "{f}" AS x, "index" AS y FROM indexed''' for f in _REGRESSED)}),
moments AS (
  SELECT feature, COUNT(*) AS n, CASE WHEN feature = 'index' THEN 1.0::DOUBLE
         ELSE covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) END AS r FROM long GROUP BY feature
),
tested AS (
  SELECT feature AS key, r AS beta, n, n - 2 AS df,
         CASE WHEN r = 1 THEN 'inf'::DOUBLE ELSE r * sqrt(n - 2) / sqrt(1 - r * r) END AS t
  FROM moments WHERE r IS NOT NULL
), {P_VALUE},
scored AS (SELECT s.key AS feature, beta, p, n FROM tested s JOIN p_values v ON s.key = v.key)
{_both_ends('scored', 'feature', 'feature, round(beta, 6) AS beta, round(p, 6) AS p, n', 20, 'beta')}"""

CHAR_MOMENTS = r"""
WITH chars AS (
  SELECT doc_id, lower(ch) AS letter FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents)
  WHERE regexp_matches(ch, '^\p{L}$')
),
counts AS (
  SELECT doc_id, letter, COUNT(*) AS n FROM chars GROUP BY doc_id, letter
),
sums AS (
  SELECT letter, CAST(SUM(n) AS DOUBLE) AS total, CAST(SUM(n * n) AS DOUBLE) AS total_squares, COUNT(*) AS holding
  FROM counts GROUP BY letter
),
letters AS (SELECT chr(CAST(i AS INTEGER)) AS letter FROM range(97, 123) r(i)),
every AS (
  SELECT COALESCE(s.letter, l.letter) AS letter, COALESCE(total, 0) AS total, COALESCE(total_squares, 0) AS total_squares,
         CASE WHEN l.letter IS NULL THEN holding ELSE (SELECT COUNT(*) FROM documents) END AS docs
  FROM sums s FULL JOIN letters l ON s.letter = l.letter
),
means AS (SELECT *, round(total / docs, 4) AS mean FROM every)
SELECT letter, total, total_squares, docs, mean, round(sqrt(abs(total_squares / docs - mean * mean)), 4) AS std FROM means"""

_YEAR = "SELECT o_custkey AS element FROM orders WHERE year(o_orderdate) = {}"
_R, _S = _YEAR.format(1995), _YEAR.format(1996)

SAMPLED_KEYS = """
keys AS (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL),
ordered AS (
  SELECT o_custkey, row_number() OVER (ORDER BY md5('s1|' || CAST(o_custkey AS VARCHAR))) AS place,
         COUNT(*) OVER () AS n FROM keys
),
sample AS (SELECT o_custkey FROM ordered WHERE place <= floor(n * 0.02::DOUBLE))"""
_SAMPLED_ROWS = f"""WITH {SAMPLED_KEYS}
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT o_custkey FROM sample)"""
HASH_SAMPLE = """
SELECT COUNT(value) AS n, round(AVG(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events
WHERE CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 50 = 7"""


def _rounded(columns: list[str]) -> str:
    return ", ".join(f"round({_quoted(c)}, 6) AS {_quoted(c)}" for c in columns)


def _mean(columns: list[str]) -> str:
    return ", ".join(f"AVG({c}) AS {c}" for c in columns)


_CODED = f"""
coded AS (
  SELECT n.*, m.entity FROM numbers n JOIN zip_map m ON TRY_CAST(substr(n.zip_text, 1, 9) AS BIGINT) = m.zip
  WHERE n.year >= 1997
)"""
PREPARED_BY_YEAR = f"""WITH {PLACES}, {NUMBERS}, {ZIP_MAP}, {_CODED}, {EXTERNAL},
means AS (
  SELECT entity, year, AVG(completions) AS completions, AVG(tuition) AS tuition FROM coded
  WHERE completions IS NOT NULL AND tuition IS NOT NULL GROUP BY entity, year
),
panel AS (SELECT m.*, f.* EXCLUDE (entity, year) FROM means m JOIN filled f ON m.entity = f.entity AND m.year = f.year),
shared AS (SELECT *, {CAPPED_SHARE} AS share FROM panel)
SELECT entity, year, {_rounded(['completions', 'tuition', 'unemployment', 'high_school', 'some_college', 'bachelor', 'population', 'share'])},
       round({_index('share')}, 6) AS "index" FROM shared"""
PREPARED_BY_ENTITY = f"""WITH {PLACES}, {NUMBERS}, {ZIP_MAP}, {_CODED}, {EXTERNAL},
means AS (
  SELECT entity, AVG(completions) AS completions, AVG(tuition) AS tuition, AVG(loans) AS loans FROM coded GROUP BY entity
),
outer_means AS (
  SELECT entity, AVG(unemployment) AS unemployment, AVG(high_school) AS high_school, AVG(some_college) AS some_college,
         AVG(bachelor) AS bachelor, AVG(population) AS population FROM joined GROUP BY entity
),
panel AS (SELECT m.*, o.* EXCLUDE (entity) FROM means m JOIN outer_means o ON m.entity = o.entity),
shared AS (SELECT *, {OPEN_SHARE} AS share FROM panel)
SELECT entity, {_rounded(['completions', 'tuition', 'loans', 'unemployment', 'high_school', 'some_college', 'bachelor', 'population', 'share'])},
       round({_index('share')}, 6) AS "index" FROM shared"""

_PLACE_COLUMNS = "place, line, year, zip_text, completions, tuition, loans, rare"
_BIN = " + ".join(f'CAST("index" >= {0.4 + 0.2 * j / 15!r}::DOUBLE AS INTEGER)' for j in range(16))

ZIP_JOIN = f"""WITH {PLACES}, {ZIP_MAP} SELECT place, line, year, zip_text, zip, entity
FROM (SELECT *, TRY_CAST(substr(zip_text, 1, 9) AS BIGINT) AS code FROM places) p JOIN zip_map m ON p.code = m.zip
WHERE year >= 1997"""

QUARANTINE = """
SELECT CASE WHEN e > 2 THEN id END AS transaction_id, CASE WHEN e > 2 THEN event_type END AS moment,
       CASE WHEN e > 2 THEN u END AS user_id, CASE WHEN e > 2 THEN value END AS amount,
       CASE e WHEN 0 THEN concat_ws(',', id, event_type, u, 'n/a') WHEN 1 THEN concat_ws(',', id, event_type)
              WHEN 2 THEN concat_ws(',', id, event_type, u, '') END AS line,
       CASE WHEN e < 2 THEN 'unreadable' WHEN e = 2 THEN 'no amount' END AS reason
FROM (SELECT *, event_id % 10 AS e, CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS u FROM events)"""

ENTITY_JOIN = f"""WITH {CELLS} SELECT a.entity, a.year, round(a.completions, 6) AS completions,
b.year AS other_year, round(b.unemployment, 6) AS unemployment FROM cells a JOIN cells b ON a.entity = b.entity"""

ALL: dict[str, str] = {
    "word_count": f"""
SELECT word, COUNT(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '{SPACE}')) AS word FROM documents)
WHERE word <> '' GROUP BY word""",
    "char_moments": CHAR_MOMENTS,
    "set_difference": f"""
SELECT element FROM (SELECT element, 'R' AS label FROM ({_R}) UNION ALL SELECT element, 'S' FROM ({_S}))
GROUP BY element HAVING COUNT(*) = 1 AND MAX(label) = 'R' AND MIN(label) = 'R'""",
    "set_difference_distinct": f"{_R} EXCEPT {_S}",
    "set_intersection": f"{_R} INTERSECT {_S}",
    "dense_to_coo": """
SELECT vec_id AS label, (p - 1) // 8 AS i, (p - 1) % 8 AS j, CAST(embedding[p] AS DOUBLE) AS v
FROM embeddings, range(1, 65) r(p) WHERE abs(embedding[p]) >= 0.01::DOUBLE""",
    "top_tokens": f"WITH {TOKENS} SELECT word, n FROM top",
    "word_frequencies": f"WITH {TOKENS} SELECT doc_id, word, round(frequency, 9) AS frequency FROM freqs",
    "sampled_keys": f"WITH {SAMPLED_KEYS} SELECT o_custkey FROM sample",
    "sampled_rows": _SAMPLED_ROWS,
    "sampled_rows_by_join": _SAMPLED_ROWS,
    "two_pass_sample": f"""WITH rows AS ({_SAMPLED_ROWS})
SELECT COUNT(o_totalprice) AS n, round(AVG(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS std FROM rows""",
    "hash_sample": HASH_SAMPLE,
    "hash_sample_stream": HASH_SAMPLE,
    "txn_csv_stream": HASH_SAMPLE,
    "word_regression": WORD_REGRESSION,
    "word_regression_controlled": WORD_REGRESSION_CONTROLLED,
    "word_regression_drop": WORD_REGRESSION_DROP,
    "word_regression_ols": WORD_REGRESSION_OLS,
    "feature_regression": FEATURE_REGRESSION,
    "panel_file_regression": FEATURE_REGRESSION,
    "last_rating": f'WITH {RATINGS} SELECT "user", item, rating FROM ratings',
    "support_filter": f'WITH {SUPPORTED} SELECT "user", item, rating FROM supported',
    "item_neighbours": f"WITH {NEIGHBOURS} SELECT target, item, round(similarity, 6) AS similarity, rank FROM neighbours",
    "item_neighbours_other": f"""WITH {NEIGHBOURS.replace("WHERE nt.norm", "WHERE dots.item <> target AND nt.norm")}
SELECT target, item, round(similarity, 6) AS similarity, rank FROM neighbours""",
    "all_item_neighbours": f"""WITH {NEIGHBOURS.replace("ORDER BY item LIMIT 2", "")}
SELECT target, item, round(similarity, 6) AS similarity, rank FROM neighbours""",
    "predict_ratings": f"""WITH {NEIGHBOURS},
sums AS (
  SELECT n.target, r."user", SUM(r.rating * n.similarity) / SUM(n.similarity) AS predicted
  FROM supported r JOIN neighbours n ON r.item = n.item GROUP BY 1, 2 HAVING COUNT(*) >= 2
)
SELECT s.target, s."user", round(COALESCE(o.rating, s.predicted), 6) AS rating, o.rating IS NOT NULL AS known
FROM sums s LEFT JOIN supported o ON o."user" = s."user" AND o.item = s.target
WHERE COALESCE(o.rating, s.predicted) > 0""",
    "clean_numeric": f"WITH {PLACES}, {NUMBERS} SELECT place, line, year, completions, tuition, loans, rare FROM numbers",
    "null_ratios": f"""WITH {PLACES} SELECT
{', '.join(f"round(AVG(CASE WHEN {c} IS NULL OR {c} = '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS {c}" for c in ('completions', 'tuition', 'loans', 'rare'))}
FROM places""",
    "drop_sparse_columns": f"WITH {PLACES} SELECT place, line, year, zip_text, completions, tuition FROM places",
    "drop_sparse_columns_wide": f"WITH {PLACES} SELECT place, line, year, zip_text, completions, tuition, loans FROM places",
    "drop_sparse_rows": f"""WITH {PLACES}, marked AS (
  SELECT place, line, year, zip_text, nullif(nullif(completions, 'PrivacySuppressed'), '') AS completions,
         nullif(tuition, '') AS tuition, loans, rare FROM places)
SELECT * FROM marked WHERE CAST(completions IS NULL AS INT) + CAST(tuition IS NULL AS INT)
  + CAST(loans IS NULL AS INT) + CAST(rare IS NULL AS INT) < 2""",
    "drop_incomplete_rows": f"""WITH {PLACES}, {NUMBERS} SELECT {_PLACE_COLUMNS} FROM numbers
WHERE zip_text IS NOT NULL AND completions IS NOT NULL AND tuition IS NOT NULL AND loans IS NOT NULL AND rare IS NOT NULL""",
    "fill_global": f"""WITH {EXTERNAL} SELECT entity, year,
{_rounded(['high_school', 'some_college', 'bachelor', 'population'])} FROM filled""",
    "fill_group_mean": f"""WITH {PLACES}, {NUMBERS} SELECT place, line, year, zip_text,
round(COALESCE(completions, AVG(completions) OVER (PARTITION BY zip_text)), 6) AS completions,
round(COALESCE(loans, AVG(loans) OVER (PARTITION BY zip_text)), 6) AS loans FROM numbers WHERE zip_text IS NOT NULL""",
    "zip_join": ZIP_JOIN,
    "zip_join_cut": ZIP_JOIN,
    "panel_mean": """SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS BIGINT) AS year,
round(AVG(l_quantity), 6) AS l_quantity, round(AVG(l_extendedprice), 6) AS l_extendedprice FROM lineitem GROUP BY 1, 2""",
    "entity_mean": f"""WITH {CELLS} SELECT entity,
{', '.join(f'round(AVG({c}), 6) AS {c}' for c in FEATURES)} FROM cells GROUP BY entity""",
    "panel_join": f"""WITH {EXTERNAL} SELECT entity, year,
{_rounded(['unemployment', 'high_school', 'bachelor', 'population'])} FROM joined""",
    "entity_join": ENTITY_JOIN,
    "entity_join_grid": ENTITY_JOIN,
    "prepared_by_year": PREPARED_BY_YEAR,
    "prepared_by_entity": PREPARED_BY_ENTITY,
    "composite_index": f"""WITH {CELLS} SELECT entity, year, round({OPEN_SHARE}, 6) AS share,
round({_index(OPEN_SHARE)}, 6) AS "index", round({_index(CAPPED_SHARE)}, 6) AS capped_index FROM cells""",
    "trend_series": f"""WITH {INDEXED}, chosen AS (SELECT * FROM indexed WHERE entity IN (1, 2, 3, 5))
{_long('chosen', 'entity, year', ['unemployment', 'bachelor', 'index'])}""",
    "index_bins": f"""WITH {INDEXED} SELECT lpad(CAST(entity AS VARCHAR), 5, '0') AS code, round("index", 6) AS "index",
CAST({_BIN} AS INTEGER) AS bin FROM indexed WHERE year = 1998""",
    "endpoint_scale": f"WITH {_scaled('endpoint')} {_long('scaled', 'entity', FEATURES)}",
    "minmax_scale": f"WITH {_scaled('minmax')} {_long('scaled', 'entity', FEATURES)}",
    "feature_vectors": f"WITH {_scaled('endpoint')} {_places('scaled', sorted(FEATURES))}",
    "gap_vectors": f"""WITH {_scaled('endpoint', GAPS)},
filled AS (SELECT entity, {', '.join(f'COALESCE({f}, 0) AS {f}' for f in FEATURES)} FROM scaled),
sized AS (SELECT *, sqrt({' + '.join(f'{f} * {f}' for f in FEATURES)}) AS size FROM filled)
{_places('sized', FEATURES, 'size')}""",
    "pair_similarity": f"""WITH {COSINES}
{_both_ends('cosines', 'a, b', 'a, b, round(similarity, 6) AS similarity', 10, 'similarity')}""",
    "panel_file_pairs": f"""WITH {COSINES}
{_both_ends('cosines', 'a, b', 'a, b, round(similarity, 6) AS similarity', 10, 'similarity')}""",
    "pair_lookup": f"WITH {COSINES} SELECT a, b, round(similarity, 6) AS similarity FROM cosines WHERE a = 3 AND b = 7",
    "entity_neighbours": _neighbour_lists("WHERE a.entity IN (0, 3, 7)"),
    "all_entity_neighbours": _neighbour_lists(""),
    "txn_csv_scan": """SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_type AS moment,
CAST(user_id AS VARCHAR) AS user_id, value AS amount FROM events""",
    "json_scan": """SELECT CAST(doc_id AS VARCHAR) AS "reviewerID", source AS asin, text AS "reviewText",
CAST(n_chars AS DOUBLE) AS overall, lang = 'en' AS verified FROM documents""",
    "csv_round_trip": f"""WITH {INDEXED} SELECT CAST(entity AS DOUBLE) AS entity, CAST(year AS DOUBLE) AS year,
{_rounded([*FEATURES, 'share', 'index'])} FROM indexed""",
    "header_csv_scan": f"""WITH {PLACES} SELECT CAST(place AS VARCHAR) AS place, CAST(line AS VARCHAR) AS line,
CAST(year AS VARCHAR) AS year, zip_text, completions, nullif(tuition, '') AS tuition, loans, rare FROM places""",
    "txn_csv_quarantine": QUARANTINE,
    "txn_csv_quarantine_stream": QUARANTINE,
    "json_quarantine": """
SELECT CASE WHEN reason IS NULL THEN CAST(doc_id AS VARCHAR) END AS "reviewerID", CASE WHEN reason IS NULL THEN source END AS asin,
       CASE WHEN reason IS NULL THEN CAST(n_chars AS DOUBLE) END AS overall, reason,
       CASE WHEN reason = 'unreadable' THEN '{"reviewerID":"' || CAST(doc_id AS VARCHAR) END AS line
FROM (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'unreadable' WHEN doc_id % 5 = 0 OR n_chars IS NULL THEN 'no overall' END AS reason
      FROM documents)""",
    "hash_sample_durable": HASH_SAMPLE,
    "panel_join_laid_out": f"""WITH {CELLS} SELECT entity, year, round(completions, 6) AS completions,
round(unemployment, 6) AS unemployment FROM cells WHERE year BETWEEN 1995 AND 1997 AND (entity + year) % 3 <> 0""",
    "panel_mean_laid_out": """SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS BIGINT) AS year,
round(AVG(l_quantity), 6) AS l_quantity, round(AVG(l_extendedprice), 6) AS l_extendedprice FROM lineitem
WHERE year(l_shipdate) BETWEEN 1995 AND 1997 GROUP BY 1, 2""",
}
