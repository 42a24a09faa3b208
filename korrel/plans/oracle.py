"""DuckDB SQL for the registered queries, written apart from the DataFrame code: text in, the same rows out."""

from __future__ import annotations

from ..functions import dictionaries as D
from ..operators.metrics import GRID
from .entities import BUSINESS
from .queries import THRESHOLD

PUNCT = r"[^\p{L}\p{N}_\s]"


def _text(x: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if x is None else "'" + x.replace("'", "''") + "'"


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in table.items()) + "}"


def _in(words) -> str:
    return "(" + ", ".join(map(_text, words)) + ")"


def _known(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR lower(trim({x})) IN {_in(D.NULL_WORDS)} THEN '' ELSE {x} END)"


def _spaced(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '{PUNCT}', ' ', 'g'), '\s+', ' ', 'g'))"


def clean(x: str) -> str:
    return _spaced(f"replace(lower({_known(x)}), '&', ' and ')")


def tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def _mapped(x: str, table: dict[str, str]) -> str:
    return f"array_to_string(list_transform({tokens(x)}, lambda t: coalesce({_map(table)}[t], t)), ' ')"


def name(x: str) -> str:
    return _mapped(clean(x), D.NAME_WORDS)


def root(c: str) -> str:
    bare = f"regexp_replace({c}, '(?:(?:^| )(?:{'|'.join(D.ROOT_SUFFIXES)}))+$', '')"
    return f"(CASE WHEN {bare} = '' THEN {c} ELSE {bare} END)"


def address(x: str) -> str:
    # each word between two spaces of its own, so that neighbours are found too
    out = f"(' ' || replace({clean(x)}, ' ', '  ') || ' ')"
    for state, code in D.STATES.items():
        if state.count(" ") == 1:
            out = f"replace({out}, ' {state.replace(' ', '  ')} ', ' {code} ')"
    out = rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"
    return _mapped(out, {**D.ADDRESS_WORDS, **{s: c for s, c in D.STATES.items() if " " not in s}})


def numbers(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({_known(x)}, '[^\p{{L}}\p{{N}}_]+'), lambda t: regexp_full_match(t, '\p{{Nd}}+'))"


def country(x: str) -> str:
    return f"coalesce({_map(D.COUNTRIES)}[{clean(x)}], {clean(x)})"


def words(x: str) -> str:
    return f"list_distinct({tokens(x)})"


def grams(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, length({x}) + 1), lambda i: substr(' ' || {x} || ' ', i, 3))) END)"


def _given(x: str) -> str:
    return f"(CASE WHEN {x} NOT IN {_in(D.NA_WORDS)} THEN {x} END)"


def block_name(x: str) -> str:
    base = _spaced(f"lower(coalesce({_given(x)}, ''))")
    return f"array_to_string(list_filter({tokens(base)}, lambda t: t NOT IN {_in(D.BLOCK_LEGAL)}), ' ')"


def block_address(x: str) -> str:
    return _mapped(_spaced(f"lower(coalesce({_given(x)}, ''))"), D.BLOCK_ADDRESS)


#: Letters of the tables beyond ASCII, and capitals, which cleaned texts lack, in their place: this distance counts bytes.
BEYOND, CAPITALS = "ßäçèéêíñóöü", "ABCDEFGHIJK"


def _distance(a: str, b: str) -> str:
    return f"levenshtein(translate({a}, '{BEYOND}', '{CAPITALS}'), translate({b}, '{BEYOND}', '{CAPITALS}'))"


def edit(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = {b} THEN CAST(1 AS DOUBLE) WHEN {a} = '' OR {b} = '' THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) - CAST({_distance(a, b)} AS DOUBLE) / CAST(greatest(length({a}), length({b})) AS DOUBLE) END)"


def _guarded(a: str, b: str, v: str) -> str:
    return f"(CASE WHEN {a} = {b} THEN CAST(1 AS DOUBLE) WHEN {a} = '' OR {b} = '' THEN CAST(0 AS DOUBLE) ELSE {v} END)"


def token_sort(a: str, b: str) -> str:
    def s(x: str) -> str:
        return f"array_to_string(list_sort({tokens(x)}), ' ')"

    return _guarded(a, b, edit(s(a), s(b)))


def _less(x: str, y: str) -> str:
    return f"array_to_string(list_sort(list_filter({x}, lambda t: NOT list_contains({y}, t))), ' ')"


def token_set(a: str, b: str) -> str:
    x, y = words(a), words(b)
    both = f"array_to_string(list_sort(list_filter({x}, lambda t: list_contains({y}, t))), ' ')"
    one, two = f"trim({both} || ' ' || {_less(x, y)})", f"trim({both} || ' ' || {_less(y, x)})"
    return _guarded(a, b, f"greatest({edit(both, one)}, {edit(both, two)}, {edit(one, two)})")


def jaccard(x: str, y: str) -> str:
    both = f"CAST(len(list_intersect({x}, {y})) AS DOUBLE)"
    return f"(CASE WHEN len({x}) = 0 AND len({y}) = 0 THEN CAST(1 AS DOUBLE) WHEN len({x}) = 0 OR len({y}) = 0 THEN CAST(0 AS DOUBLE) ELSE {both} / (CAST(len({x}) + len({y}) AS DOUBLE) - {both}) END)"


BUSINESS_CTE = "business(entity_id, business_name, business_address, country) AS (VALUES " + ", ".join("(" + ", ".join(map(_text, r)) + ")" for r in BUSINESS) + ")"
NAMES_CTE = f"""{BUSINESS_CTE}, named AS (
  SELECT entity_id AS id, business_name AS x FROM business
  UNION ALL SELECT 'p' || p_partkey, p_name FROM part UNION ALL SELECT 'c' || c_custkey, c_name FROM customer)"""
ADDRESSES_CTE = f"""{BUSINESS_CTE}, addressed AS (
  SELECT entity_id AS id, business_address AS x FROM business
  UNION ALL SELECT 's' || s_suppkey, s_suppkey || ' ' || s_name || ' Street, ' || n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
ENT = f"""cleaned AS (SELECT doc_id, lang, string_split({clean('text')}, ' ') AS w FROM documents), ent AS (
  SELECT 'S' || (doc_id % 3 + 1) AS source, 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, array_to_string(w[1:5], ' ') AS business_name,
    array_to_string(w[6:14], ' ') AS business_address, lang AS country, CASE WHEN len(w) >= 30 THEN array_to_string(w[15:30], ' ') END AS same, doc_id AS ord FROM cleaned)"""
TRUTH = """truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS target_id FROM ent a JOIN ent b
  ON a.source = 'S1' AND b.source <> 'S1' AND a.country = b.country AND a.same = b.same)"""
TOK = f"""tok AS (
  SELECT source, country, 'name' AS field, entity_id, unnest(list_filter({tokens(block_name('business_name'))}, lambda t: length(t) >= 3)) AS token FROM ent WHERE {_given('country')} IS NOT NULL
  UNION ALL
  SELECT source, country, 'address', entity_id, unnest(list_filter({tokens(block_address('business_address'))}, lambda t: length(t) >= 3)) FROM ent WHERE {_given('country')} IS NOT NULL)"""
FREQ = "freq AS (SELECT source, country, field, token, count(*) AS freq FROM tok GROUP BY ALL)"


def _pairs(k: int, field: str = "") -> str:
    only = f" AND a.field = '{field}'" if field else ""
    return f"""kept AS (SELECT tok.* FROM tok JOIN freq USING (source, country, field, token) WHERE freq <= {k}), pairs AS (
  SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cand_id FROM kept a JOIN kept b
  ON a.country = b.country AND a.field = b.field AND a.token = b.token AND a.source = 'S1' AND b.source <> 'S1'{only})"""


def _blocked(k: int = 25, field: str = "") -> str:
    return f"{ENT}, {TRUTH}, {TOK}, {FREQ}, {_pairs(k, field)}"


PAIRED = f"""{ENT}, {TOK}, {FREQ}, {_pairs(25)}, xy AS (
  SELECT s1_id, cand_id, a.business_name AS x, b.business_name AS y FROM pairs JOIN ent a ON a.entity_id = s1_id JOIN ent b ON b.entity_id = cand_id)"""


def _sim(expression: str) -> str:
    return f"WITH {PAIRED} SELECT s1_id, cand_id, {expression} AS sim FROM xy"


def _features() -> dict[str, str]:
    def where(c: str, v: str, other: str = "0") -> str:
        return f"CASE WHEN {c} THEN {v} ELSE CAST({other} AS DOUBLE) END"

    def flag(c: str) -> str:
        return f"CASE WHEN {c} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"

    named, placed, landed = "(a.name <> '' AND b.name <> '')", "(a.addr <> '' AND b.addr <> '')", "(a.country <> '' AND b.country <> '')"

    def numeric(v: str) -> str:
        return f"CASE WHEN len(a.nums) > 0 AND len(b.nums) > 0 THEN {v} WHEN len(a.nums) = 0 AND len(b.nums) = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"

    return {
        "name_edit_sim": where(named, edit("a.name", "b.name")),
        "name_root_edit_sim": where(named, edit("a.root", "b.root")),
        "name_token_sort_sim": where(named, token_sort("a.name", "b.name")),
        "name_token_set_sim": where(named, token_set("a.name", "b.name")),
        "name_jaccard_word": where(named, jaccard(words("a.name"), words("b.name"))),
        "name_jaccard_char_3gram": where(named, jaccard(grams("a.name"), grams("b.name"))),
        "name_exact_match": where(named, flag("a.name = b.name")),
        "name_length_diff": where(named, "CAST(abs(length(a.name) - length(b.name)) AS DOUBLE) / greatest(length(a.name), length(b.name))", "1"),
        "addr_edit_sim": where(placed, edit("a.addr", "b.addr")),
        "addr_token_sort_sim": where(placed, token_sort("a.addr", "b.addr")),
        "addr_token_set_sim": where(placed, token_set("a.addr", "b.addr")),
        "addr_jaccard_word": where(placed, jaccard(words("a.addr"), words("b.addr"))),
        "addr_jaccard_char_3gram": where(placed, jaccard(grams("a.addr"), grams("b.addr"))),
        "addr_exact_match": where(placed, flag("a.addr = b.addr")),
        "addr_numeric_exact": numeric(flag("list_sort(a.nums) = list_sort(b.nums)")),
        "addr_numeric_jaccard": numeric(jaccard("a.nums", "b.nums")),
        "addr_numeric_has_overlap": numeric(flag("len(list_intersect(a.nums, b.nums)) > 0")),
        "country_match": where(landed, flag("a.country = b.country"), "0.5"),
        "name_missing": flag(f"NOT {named}"),
        "addr_missing": flag(f"NOT {placed}"),
        "country_missing": flag(f"NOT {landed}"),
    }


def _feature_query(first: int, last: int) -> str:
    targets = ("S2-1", "S3-1", "S2-2", "S2-3", "S3-3", "S2-5", "S2-6", "S3-6", "S2-999")
    columns = ", ".join(f"{v} AS {k}" for k, v in list(_features().items())[first:last])
    return f"""WITH {BUSINESS_CTE}, {ENT}, {TOK}, {FREQ}, {_pairs(25)}, every AS (
      SELECT 'd' AS kind, s1_id, cand_id FROM pairs UNION ALL SELECT 'b', entity_id, unnest([{', '.join(map(_text, targets))}]) FROM business WHERE starts_with(entity_id, 'S1-')
    ), raw AS (
      SELECT 'd' AS kind, entity_id, business_name, business_address, country FROM ent UNION ALL SELECT 'b', * FROM business
    ), prep AS (
      SELECT kind, entity_id, {name('business_name')} AS name, {address('business_address')} AS addr, {country('country')} AS country, list_distinct({numbers('business_address')}) AS nums FROM raw
    ), whole AS (
      SELECT e.s1_id, e.cand_id,
        {{'name': coalesce(a.name, ''), 'root': coalesce({root('a.name')}, ''), 'addr': coalesce(a.addr, ''), 'country': coalesce(a.country, ''), 'nums': coalesce(a.nums, []::VARCHAR[])}} AS a,
        {{'name': coalesce(b.name, ''), 'root': coalesce({root('b.name')}, ''), 'addr': coalesce(b.addr, ''), 'country': coalesce(b.country, ''), 'nums': coalesce(b.nums, []::VARCHAR[])}} AS b
      FROM every e LEFT JOIN prep a ON a.kind = e.kind AND a.entity_id = e.s1_id LEFT JOIN prep b ON b.kind = e.kind AND b.entity_id = e.cand_id
    ) SELECT s1_id, cand_id, {columns} FROM whole"""


SCORED = f"""{_blocked()}, scored AS (
  SELECT s1_id, cand_id, CAST(0.4 AS DOUBLE) * CASE WHEN a.name <> '' AND b.name <> '' THEN {jaccard(words('a.name'), words('b.name'))} ELSE 0 END
    + CAST(0.4 AS DOUBLE) * CASE WHEN a.addr <> '' AND b.addr <> '' THEN {jaccard(words('a.addr'), words('b.addr'))} ELSE 0 END
    + CAST(0.2 AS DOUBLE) * CASE WHEN a.name <> '' AND b.name <> '' THEN {jaccard(grams('a.name'), grams('b.name'))} ELSE 0 END AS prob
  FROM pairs JOIN (SELECT entity_id, {name('business_name')} AS name, {address('business_address')} AS addr FROM ent) a ON a.entity_id = s1_id
  JOIN (SELECT entity_id, {name('business_name')} AS name, {address('business_address')} AS addr FROM ent) b ON b.entity_id = cand_id
), labelled AS (
  SELECT s.*, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM scored s LEFT JOIN (SELECT DISTINCT * FROM truth) t ON t.s1_id = s.s1_id AND t.target_id = s.cand_id
)"""


def _rates(counts: str) -> str:
    p = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)"
    r = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)"

    def f(b2: str) -> str:
        return f"CASE WHEN precision <= 0 OR recall <= 0 THEN CAST(0 AS DOUBLE) ELSE (1 + CAST({b2} AS DOUBLE)) * precision * recall / (CAST({b2} AS DOUBLE) * precision + recall) END"

    return f"SELECT *, {f('0.25')} AS f_beta, {f('1')} AS f1 FROM (SELECT *, {p} AS precision, {r} AS recall FROM ({counts}))"


_CONFUSION = f"""SELECT count(*) FILTER (WHERE prob >= {THRESHOLD} AND label = 1) AS tp, count(*) FILTER (WHERE prob >= {THRESHOLD} AND label = 0) AS fp,
  count(*) FILTER (WHERE prob < {THRESHOLD} AND label = 1) AS fn, count(*) FILTER (WHERE prob < {THRESHOLD} AND label = 0) AS tn FROM labelled"""
_SWEEP = _rates(
    "SELECT threshold, count(*) FILTER (WHERE prob >= threshold AND label = 1) AS tp, count(*) FILTER (WHERE prob >= threshold AND label = 0) AS fp, "
    "count(*) FILTER (WHERE prob < threshold AND label = 1) AS fn, count(*) FILTER (WHERE prob < threshold AND label = 0) AS tn "
    f"FROM labelled, (SELECT unnest([{', '.join(f'CAST({t!r} AS DOUBLE)' for t in GRID)}]) AS threshold) GROUP BY threshold"
)
_RESULTS = f"""lists AS (
  SELECT s1_id, string_agg(cand_id, ',' ORDER BY prob DESC, cand_id) AS ids FROM scored WHERE prob >= {THRESHOLD} GROUP BY 1
), results AS (
  SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids FROM ent LEFT JOIN lists ON s1_id = entity_id WHERE source = 'S1'
)"""


def _profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, count(*) AS n_columns, string_agg(column_name, ',' ORDER BY column_index) AS columns, string_agg(CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END, ',' ORDER BY column_index) AS types FROM duckdb_columns() WHERE table_name = '{t}'" for t in ("documents", "part", "supplier")
    )


def sql() -> dict[str, str]:
    token = f"split_part({clean('business_name')}, ' ', 1)"
    return {
        "q_profile": _profile(),
        "q_preview": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part ORDER BY part.p_partkey LIMIT 3",
        "q_tsv_source": f"WITH {ENT} SELECT entity_id, nullif(business_name, '') AS business_name, nullif(business_address, '') AS business_address, nullif(country, '') AS country FROM ent",
        "q_combined_lookup": f"""WITH {ENT}, n AS (SELECT source, 'T-' || (ord % 500) AS entity_id, min(business_name) AS name FROM ent WHERE source <> 'S1' GROUP BY ALL)
          SELECT entity_id, arg_min(name, source) AS in_training, arg_max(name, source) AS in_prediction FROM n GROUP BY 1""",
        "q_block_mock": f"""WITH {ENT}, k AS (SELECT *, {token} AS token FROM ent), t AS (
            SELECT entity_id, token, 1 AS of, ord FROM k WHERE source = 'S3' QUALIFY row_number() OVER (ORDER BY ord, entity_id) <= 150000
            UNION ALL SELECT entity_id, token, 2, ord FROM k WHERE source = 'S2' QUALIFY row_number() OVER (ORDER BY ord, entity_id) <= 100000
          ), held AS (SELECT * FROM t WHERE token <> '' QUALIFY row_number() OVER (PARTITION BY token ORDER BY of, ord, entity_id) <= 10
          ), l AS (SELECT token, string_agg(entity_id, ',' ORDER BY of, ord, entity_id) AS ids FROM held GROUP BY 1
          ), a AS (SELECT entity_id, ids, sum(CASE WHEN ids IS NULL THEN 0 ELSE 1 END) OVER (ORDER BY ord, entity_id) AS nth FROM k LEFT JOIN l USING (token) WHERE source = 'S1')
          SELECT entity_id AS source1_entity_id, CASE WHEN ids IS NOT NULL AND nth <= 5000 THEN ids ELSE '' END AS candidate_entity_ids FROM a""",
        "q_load_source": "SELECT 'S1-' || (doc_id % 300) AS entity_id, arg_max(trim(source), doc_id) AS business_name, CAST(NULL AS VARCHAR) AS business_address, arg_max(trim(lang), doc_id) AS country FROM documents GROUP BY 1",
        "q_union_targets": f"WITH {ENT} SELECT entity_id, source, business_name, country FROM ent WHERE source <> 'S1'",
        "q_truth_long": f"WITH {ENT}, {TRUTH} SELECT DISTINCT s1_id, target_id FROM truth",
        "q_load_pairs": f"WITH {_blocked(5)} SELECT s1_id, cand_id FROM pairs",
        "q_clean_text": f"WITH {NAMES_CTE} SELECT CAST(doc_id AS VARCHAR) AS id, md5({clean('text')}) AS cleaned_md5 FROM documents UNION ALL SELECT id, md5({clean('x')}) FROM named",
        "q_norm_name": f"WITH {NAMES_CTE}, c AS (SELECT id, {name('x')} AS canonical FROM named) SELECT id, canonical, {root('canonical')} AS root FROM c",
        "q_norm_addr": f"WITH {ADDRESSES_CTE} SELECT id, {address('x')} AS norm_addr FROM addressed",
        "q_norm_country": f"WITH {BUSINESS_CTE}, c AS (SELECT entity_id AS id, country AS x FROM business UNION ALL SELECT 'n' || n_nationkey, n_name FROM nation) SELECT id, {country('x')} AS norm_country FROM c",
        "q_block_norm_name": f"WITH {NAMES_CTE} SELECT id, {block_name('x')} AS block_name FROM named",
        "q_block_norm_addr": f"WITH {ADDRESSES_CTE} SELECT id, {block_address('x')} AS block_addr FROM addressed",
        "q_numeric_tokens": f"WITH {ADDRESSES_CTE} SELECT id, array_to_string({numbers('x')}, '|') AS numbers FROM addressed",
        "q_char_ngrams": f"WITH {NAMES_CTE}, c AS (SELECT id, {clean('x')} AS x FROM named) SELECT id, array_to_string(list_sort({grams('x')}), '|') AS grams FROM c",
        "q_word_tokens": f"WITH {NAMES_CTE}, c AS (SELECT id, {clean('x')} AS x FROM named) SELECT id, array_to_string(list_sort({words('x')}), '|') AS words FROM c",
        "q_tokens": f"WITH {ENT}, {TOK} SELECT source, country, field, token, entity_id FROM tok",
        "q_token_freq": f"WITH {ENT}, {TOK}, {FREQ} SELECT * FROM freq",
        "q_token_purge": f"WITH {ENT}, {TOK}, {FREQ} SELECT source, country, field, token, entity_id FROM tok JOIN freq USING (source, country, field, token) WHERE freq <= 25",
        "q_block_name": f"WITH {_blocked(25, 'name')} SELECT s1_id, cand_id FROM pairs",
        "q_block_addr": f"WITH {_blocked(25, 'address')} SELECT s1_id, cand_id FROM pairs",
        "q_block_all": f"WITH {_blocked()} SELECT s1_id, cand_id FROM pairs",
        "q_block_grouped": f"WITH {_blocked()}, l AS (SELECT s1_id, string_agg(cand_id, ',' ORDER BY cand_id) AS ids FROM pairs GROUP BY 1) SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS candidate_entity_ids FROM ent LEFT JOIN l ON s1_id = entity_id WHERE source = 'S1'",
        "q_block_country": f"WITH {_blocked()}, m AS (SELECT s1_id, count(*) AS n FROM pairs GROUP BY 1) SELECT country, count(n) AS entities_with_candidates, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_pairs FROM ent LEFT JOIN m ON s1_id = entity_id WHERE source = 'S1' AND country IS NOT NULL GROUP BY 1",
        "q_block_first_token": f"""WITH {ENT}, k AS (SELECT *, {token} AS token FROM ent), held AS (
            SELECT token, entity_id AS cand_id FROM k WHERE source <> 'S1' AND token <> '' QUALIFY row_number() OVER (PARTITION BY token ORDER BY ord, entity_id) <= 10
          ), hit AS (SELECT entity_id AS s1_id, token FROM k WHERE source = 'S1' AND token IN (SELECT token FROM held) ORDER BY ord, entity_id LIMIT 5000)
          SELECT s1_id, cand_id FROM hit JOIN held USING (token)""",
        "q_block_recall": f"""WITH {_blocked(5)}, f AS (SELECT count(*) AS n FROM truth t WHERE EXISTS (SELECT 1 FROM pairs p WHERE p.s1_id = t.s1_id AND p.cand_id = t.target_id)),
          m AS (SELECT count(*) AS total, count(DISTINCT s1_id) AS ents FROM pairs), t AS (SELECT count(*) AS n FROM truth)
          SELECT t.n AS true_links, f.n AS found_links, CASE WHEN t.n = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(f.n AS DOUBLE) / t.n END AS recall, CAST(m.total AS BIGINT) AS total_candidates, CAST(m.total AS DOUBLE) / greatest(m.ents, 1) AS avg_candidates FROM f, m, t""",
        "q_sim_edit": _sim(edit("x", "y")),
        "q_sim_token_sort": _sim(token_sort("x", "y")),
        "q_sim_token_set": _sim(token_set("x", "y")),
        "q_sim_jaccard_word": _sim(jaccard(words("x"), words("y"))),
        "q_sim_jaccard_3gram": _sim(jaccard(grams("x"), grams("y"))),
        "q_feat_name": _feature_query(0, 8),
        "q_feat_addr": _feature_query(8, 14),
        "q_feat_numeric": _feature_query(14, 17),
        "q_feat_country_missing": _feature_query(17, 21),
        "q_features_all": _feature_query(0, 21),
        "q_label_pairs": f"WITH {_blocked()} SELECT p.s1_id, p.cand_id, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM pairs p LEFT JOIN (SELECT DISTINCT * FROM truth) t ON t.s1_id = p.s1_id AND t.target_id = p.cand_id",
        "q_positives": f"WITH {ENT}, {TRUTH} SELECT s1_id, target_id AS cand_id FROM (SELECT DISTINCT * FROM truth) ORDER BY md5('|' || s1_id || '|' || target_id), 1, 2 LIMIT 1000",
        "q_negatives": f"""WITH {ENT}, {TRUTH}, k AS (SELECT *, {token} AS token FROM ent), few AS (
            SELECT * FROM k WHERE source <> 'S1' ORDER BY md5('sample|' || entity_id), entity_id LIMIT 150000
          ), held AS (
            SELECT token, entity_id AS cand_id FROM few WHERE token <> '' QUALIFY row_number() OVER (PARTITION BY token ORDER BY md5('|' || entity_id), entity_id) <= 25
          ), p AS (SELECT entity_id AS s1_id, cand_id FROM k JOIN held USING (token) WHERE source = 'S1')
          SELECT s1_id, cand_id FROM p WHERE NOT EXISTS (SELECT 1 FROM truth t WHERE t.s1_id = p.s1_id AND t.target_id = p.cand_id) ORDER BY md5('hard|' || s1_id || '|' || cand_id), 1, 2 LIMIT 500""",
        "q_split": f"""WITH {_blocked()}, i AS (SELECT s1_id, row_number() OVER (ORDER BY md5('split|' || s1_id), s1_id) AS nth, count(*) OVER () AS n FROM (SELECT DISTINCT s1_id FROM pairs))
          SELECT p.s1_id, p.cand_id, nth <= floor(n * CAST(0.2 AS DOUBLE)) AS validation FROM pairs p JOIN i ON i.s1_id = p.s1_id""",
        "q_class_weights": f"WITH {SCORED} SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight FROM labelled GROUP BY label",
        "q_confusion": f"WITH {SCORED} {_CONFUSION}",
        "q_pair_metrics": f"WITH {SCORED} {_rates(_CONFUSION)}",
        "q_threshold_sweep": f"WITH {SCORED} {_SWEEP}",
        "q_best_threshold": f"WITH {SCORED}, sw AS ({_SWEEP}) SELECT *, floor(f_beta * 10000 + CAST(0.5 AS DOUBLE)) / 10000 AS score FROM sw ORDER BY floor(f_beta * 10000 + CAST(0.5 AS DOUBLE)) DESC, threshold LIMIT 1",
        "q_entity_metrics": f"""WITH {SCORED}, t AS (SELECT DISTINCT s1_id, target_id FROM truth), p AS (SELECT s1_id, cand_id AS target_id FROM scored WHERE prob >= {THRESHOLD})
          {_rates("SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS tp, count(*) FILTER (WHERE a IS NULL) AS fp, count(*) FILTER (WHERE b IS NULL) AS fn FROM (SELECT t.s1_id AS a, p.s1_id AS b FROM t FULL JOIN p ON t.s1_id = p.s1_id AND t.target_id = p.target_id)")}""",
        "q_results": f"WITH {SCORED}, {_RESULTS} SELECT * FROM results",
        "q_results_at_best": f"WITH {SCORED}, sw AS ({_SWEEP}), best AS (SELECT threshold FROM sw ORDER BY floor(f_beta * 10000 + CAST(0.5 AS DOUBLE)) DESC, threshold LIMIT 1), {_RESULTS.replace(f'>= {THRESHOLD}', '>= (SELECT threshold FROM best)')} SELECT * FROM results",
        "q_results_summary": f"WITH {SCORED}, {_RESULTS} SELECT count(*) AS entities, count(*) FILTER (WHERE matched_entity_ids <> '') AS with_match, count(*) FILTER (WHERE matched_entity_ids = '') AS without_match FROM results",
        "q_validate": f"""WITH {SCORED}, {_RESULTS}, own AS (SELECT source1_entity_id AS s1_id, unnest(list_filter(string_split(matched_entity_ids, ','), lambda x: x <> '')) AS target_id FROM results), s AS (SELECT entity_id FROM ent WHERE source = 'S1')
          SELECT 'columns' AS rule, CAST(0 AS BIGINT) AS violations, 'candidates' AS checked
          UNION ALL SELECT 'duplicate_s1', count(*) - count(DISTINCT entity_id), 'candidates' FROM s
          UNION ALL SELECT 'missing_s1', count(*), 'candidates' FROM (SELECT DISTINCT s1_id FROM truth) WHERE s1_id NOT IN (SELECT entity_id FROM s)
          UNION ALL SELECT 'duplicate_s1', count(*) - count(DISTINCT source1_entity_id), 'results' FROM results
          UNION ALL SELECT 'bad_prefix', count(*) FILTER (WHERE NOT regexp_matches(target_id, '^S[23]-')), 'results' FROM own
          UNION ALL SELECT 'outside_candidates', count(*), 'results' FROM own o WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.s1_id = o.s1_id AND p.cand_id = o.target_id)
          UNION ALL SELECT 'missing_s1', count(*), 'results' FROM s WHERE entity_id NOT IN (SELECT source1_entity_id FROM results)""",
    }
