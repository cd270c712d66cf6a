"""SQL counterparts of the linkage queries, for DuckDB over the same tables.

Written from the meaning of the operators, as one chain of common table expressions of which every query
takes the part it needs.
"""

from __future__ import annotations

# Fixed values, written out here once more so that a wrong list in an operator shows.
_LEGAL_WORDS = "inc incorporated corp corporation company co llc limited ltd private pvt plc llp sarl sas sa".split()
_ADDRESS_WORDS = {"road": "rd", "street": "st", "avenue": "ave", "boulevard": "blvd", "drive": "dr", "lane": "ln", "highway": "hwy", "suite": "ste", "apartment": "apt", "building": "bldg", "floor": "fl"}
_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅàáâãäåÇçÈÉÊËèéêëÌÍÎÏìíîïÑñÒÓÔÕÖØòóôõöøÙÚÛÜùúûüÝŸýÿ‘’–—«»"
_TO = "abcdefghijklmnopqrstuvwxyzaaaaaaaaaaaacceeeeeeeeiiiiiiiinnoooooooooooouuuuuuuuyyyy      "
_MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_EVIDENCE = ("name_tok", "addr_tok", "name_gram", "addr_gram", "name_pair", "addr_pair")
_FEATURES = (
    "source", "name_exact", "address_exact", "name_token_jaccard", "name_qgram_dice", "name_edit", "name_containment", "name_length_ratio",
    "address_token_jaccard", "address_qgram_dice", "address_edit", "address_containment", "address_length_ratio",
    "numeric_agree", "numeric_conflict", "numeric_overlap_ratio", "postal_agree", "postal_conflict", "retrieval_hits", "best_field", "worst_field",
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _mapped(c: str) -> str:
    t = f"translate({c}, {_q(_FROM)}, {_q(_TO)})"
    t = f"regexp_replace({t}, '[\\x{{300}}-\\x{{36F}}]', '', 'g')"
    return f"regexp_replace(replace({t}, '&', ' and '), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]', ' ', 'g')"


def _words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


_LEGAL = ", ".join(_q(w) for w in _LEGAL_WORDS)
_SHORT = "CASE w " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in _ADDRESS_WORDS.items()) + " ELSE w END"


def _grams(c: str) -> str:
    h = f"hex(encode('^^' || {c} || '$$'))"
    return f"CASE WHEN {c} = '' THEN []::varchar[] ELSE list_sort(list_distinct(list_transform(range(1, (length({h}) // 2 - 1)::bigint), lambda i: substr({h}, 2 * i - 1, 6)))) END"


def _latest(k: int) -> str:
    return f"SELECT entity_id, arg_max(struct_pack(n := coalesce(business_name, ''), a := coalesce(business_address, ''), c := coalesce(country, '')), row_no) AS v FROM train_source{k} WHERE entity_id IS NOT NULL GROUP BY entity_id"


_NUM = "try_cast(CASE WHEN instr(entity_id, '-') > 0 THEN split_part(entity_id, '-', -1) ELSE entity_id END AS bigint)"
_E = "e AS MATERIALIZED (SELECT try_cast(substr(entity_id, 2, 1) AS int) AS source, " + _NUM + " AS num, entity_id, v.n AS name, v.a AS address, v.c AS country FROM (" + " UNION ALL ".join(_latest(k) for k in (1, 2, 3)) + "))"
_N = f"""n AS (SELECT source, num, entity_id, country,
    array_to_string(list_filter({_words(_mapped('name'))}, lambda w: w NOT IN ({_LEGAL})), ' ') AS name_norm,
    array_to_string(list_transform({_words(_mapped('address'))}, lambda w: {_SHORT}), ' ') AS addr_norm FROM e)"""
_REC = f"""rec AS MATERIALIZED (SELECT *, list_sort(list_distinct({_words('name_norm')})) AS name_toks, list_sort(list_distinct({_words('addr_norm')})) AS addr_toks,
    {_grams('name_norm')} AS name_grams, {_grams('addr_norm')} AS addr_grams,
    list_sort(list_distinct(regexp_extract_all(addr_norm, '[0-9]+'))) AS addr_nums FROM n)"""
_VALUES = "vals AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT source, num, country, {k} AS kind, unnest({c}) AS val FROM rec" for c, k in (("name_toks", 1), ("addr_toks", 2), ("name_grams", 3), ("addr_grams", 4))) + ")"
_DF = "df AS MATERIALIZED (SELECT kind, val, count(*) AS df FROM vals WHERE source = 1 GROUP BY kind, val)"
_RARE = "rare AS MATERIALIZED (SELECT * FROM (SELECT v.*, df, cast(row_number() OVER (PARTITION BY source, num, v.kind ORDER BY df, v.val) AS int) AS rank FROM vals v JOIN df ON v.kind = df.kind AND v.val = df.val WHERE df <= 1000) WHERE rank <= 9)"
_COMP = "comp AS MATERIALIZED (SELECT a.source, a.num, a.country, a.kind + 4 AS tag, a.val || '|' || b.val AS val FROM rare a JOIN rare b ON a.source = b.source AND a.num = b.num AND a.kind = b.kind AND a.val < b.val WHERE a.kind >= 3 AND a.rank <= 8 AND b.rank <= 8)"
_KEYS = """keys AS MATERIALIZED (
    SELECT 1 AS tag, country, name_norm AS val, source, num FROM rec WHERE name_norm <> ''
    UNION ALL SELECT 2, country, addr_norm, source, num FROM rec WHERE addr_norm <> ''
    UNION ALL SELECT kind + 2, country, val, source, num FROM rare WHERE kind <= 2 AND rank <= CASE WHEN source = 1 THEN 3 ELSE 5 END
    UNION ALL SELECT kind + 2, country, val, source, num FROM rare WHERE kind >= 3 AND rank <= CASE WHEN source = 1 THEN 5 ELSE 9 END AND df <= 10
    UNION ALL SELECT tag, country, val, source, num FROM comp)"""
_HITS = """hits AS MATERIALIZED (SELECT a.tag, a.num AS s1, b.source, b.num FROM keys a JOIN keys b ON a.tag = b.tag AND a.country = b.country AND a.val = b.val
    WHERE a.source = 1 AND b.source > 1 AND (a.tag, a.country, a.val) IN (SELECT (tag, country, val) FROM keys WHERE source = 1 GROUP BY tag, country, val HAVING count(*) <= 20))"""
_EV = "ev AS MATERIALIZED (SELECT s1, source, num, max((tag = 1)::int) AS name_hit, max((tag = 2)::int) AS addr_hit, " + ", ".join(f"cast(least(15, count(*) FILTER (tag = {t})) AS int) AS {n}" for t, n in enumerate(_EVIDENCE, 3)) + " FROM hits GROUP BY s1, source, num)"
_KEPT = """kept AS MATERIALIZED (SELECT *, name_tok + addr_tok + name_gram + addr_gram + 3 * (name_pair + addr_pair) + 5 * greatest(name_hit, addr_hit) AS hits FROM ev
    WHERE name_hit + addr_hit > 0 OR name_pair >= 1 OR addr_pair >= 1 OR (name_tok >= 1 AND name_gram >= 1) OR (addr_tok >= 1 AND addr_gram >= 1) OR name_gram >= 3 OR addr_gram >= 4)"""


def _both(x: str, y: str) -> str:
    return f"len(list_intersect({x}, {y}))"


def _dice(x: str, y: str) -> str:
    return f"CASE WHEN len({x}) + len({y}) = 0 THEN 1.0::double ELSE 2.0::double * {_both(x, y)} / (len({x}) + len({y})) END"


_RANK0 = f"""r0 AS (SELECT k.*, {_dice('a.name_grams', 'b.name_grams')} AS name_dice, {_dice('a.addr_grams', 'b.addr_grams')} AS addr_dice, a.addr_nums AS an, b.addr_nums AS bn
    FROM kept k JOIN rec a ON a.source = 1 AND a.num = k.s1 JOIN rec b ON b.source = k.source AND b.num = k.num)"""
_RANKED = f"""ranked AS MATERIALIZED (SELECT s1, source, num, hits, name_dice, addr_dice, (greatest(name_dice, addr_dice) + 0.70::double * least(name_dice, addr_dice)
    + 0.08::double * ({_both('an', 'bn')} > 0)::int - 0.12::double * (len(an) > 0 AND len(bn) > 0 AND {_both('an', 'bn')} = 0)::int + 0.05::double * (name_hit + addr_hit = 2)::int + 0.002::double * least(hits, 10))::float AS rank_score
    FROM r0 WHERE greatest(name_dice, addr_dice) >= 0.4::double)"""
_POS = "pos AS MATERIALIZED (SELECT *, cast(row_number() OVER (PARTITION BY s1 ORDER BY rank_score DESC, source DESC, num DESC) AS int) AS position FROM ranked)"
_TOP = "topk AS MATERIALIZED (SELECT * FROM pos WHERE position <= 50)"
_TRUTH = """tr AS (SELECT DISTINCT try_cast(split_part(source1_entity_id, '-', -1) AS bigint) AS s1,
        list_sort(list_distinct(list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(replace(x, chr(13), ''))), lambda x: x <> ''))) AS ids FROM train_matches WHERE source1_entity_id IS NOT NULL),
    tp AS MATERIALIZED (SELECT s1, try_cast(substr(id, 2, 1) AS int) AS source, try_cast(split_part(id, '-', -1) AS bigint) AS num FROM (SELECT s1, unnest(ids) AS id FROM tr)),
    tm AS (SELECT try_cast(split_part(source1_entity_id, '-', -1) AS bigint) AS s1, pos, unnest(list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(replace(x, chr(13), ''))), lambda x: x <> '')) AS id
           FROM (SELECT *, row_number() OVER () AS pos FROM train_matches) WHERE source1_entity_id IS NOT NULL),
    own AS (SELECT try_cast(substr(id, 2, 1) AS int) AS source, try_cast(split_part(id, '-', -1) AS bigint) AS num, arg_max(s1, pos) AS owner FROM tm GROUP BY 1, 2),
    tc AS (SELECT s1, sum(len(ids)) AS n_true FROM tr GROUP BY s1)"""
_M64 = "18446744073709551616::uhugeint"


def _mix(n: str) -> str:
    x0 = f"(({n})::uhugeint + 11400714819323198485::uhugeint) % {_M64}"
    x1 = f"SELECT num, xor(x, x >> 30) * 13787848793156543929::uhugeint % {_M64} AS x FROM (SELECT num, {x0} AS x FROM e WHERE source = 1)"
    x2 = f"SELECT num, xor(x, x >> 27) * 10723151780598845931::uhugeint % {_M64} AS x FROM ({x1})"
    return f"SELECT num, xor(x, x >> 31) AS x FROM ({x2})"


_FOLD = f"fold AS MATERIALIZED (SELECT num, x, (x % 5 = 0)::int AS fold FROM ({_mix('num')}))"


def _edit(x: str, y: str) -> str:
    return f"CASE WHEN {x} = '' OR {y} = '' THEN ({x} = {y})::int::double ELSE 1.0::double - levenshtein({x}, {y})::double / greatest(strlen({x}), strlen({y})) END"


def _jac(x: str, y: str) -> str:
    return f"CASE WHEN len({x}) + len({y}) = 0 THEN 1.0::double ELSE {_both(x, y)}::double / (len({x}) + len({y}) - {_both(x, y)}) END"


def _ratio(x: str, y: str) -> str:
    return f"CASE WHEN {x} = '' OR {y} = '' THEN 0.0::double ELSE least(strlen({x}), strlen({y}))::double / greatest(strlen({x}), strlen({y})) END"


def _contains(x: str, y: str) -> str:
    return f"CASE WHEN {x} = '' OR {y} = '' THEN 0.0::double ELSE (contains({x}, {y}) OR contains({y}, {x}))::int::double END"


def _feature_sql(hits: str, digits: int | None = 6) -> str:
    an, bn, aa, ba = "a.name_norm", "b.name_norm", "a.addr_norm", "b.addr_norm"
    ax, bx = "a.addr_nums", "b.addr_nums"
    ap, bp = (f"list_filter({x}, lambda n: length(n) IN (5, 6))" for x in (ax, bx))
    nd, ad = _dice("a.name_grams", "b.name_grams"), _dice("a.addr_grams", "b.addr_grams")
    filled = f"(len({ax}) > 0 AND len({bx}) > 0)"
    exprs = {
        "source": "(p.source = 3)::int::double", "name_exact": f"({an} = {bn} AND {an} <> '')::int::double", "address_exact": f"({aa} = {ba} AND {aa} <> '')::int::double",
        "name_token_jaccard": _jac("a.name_toks", "b.name_toks"), "name_qgram_dice": nd, "name_edit": _edit(an, bn), "name_containment": _contains(an, bn), "name_length_ratio": _ratio(an, bn),
        "address_token_jaccard": _jac("a.addr_toks", "b.addr_toks"), "address_qgram_dice": ad, "address_edit": _edit(aa, ba), "address_containment": _contains(aa, ba), "address_length_ratio": _ratio(aa, ba),
        "numeric_agree": f"({_both(ax, bx)} > 0)::int::double", "numeric_conflict": f"({filled} AND {_both(ax, bx)} = 0)::int::double",
        "numeric_overlap_ratio": f"CASE WHEN {filled} THEN {_both(ax, bx)}::double / greatest(len({ax}), len({bx})) ELSE 0.0::double END",
        "postal_agree": f"({_both(ap, bp)} > 0)::int::double", "postal_conflict": f"(len({ap}) > 0 AND len({bp}) > 0 AND {_both(ap, bp)} = 0)::int::double",
        "retrieval_hits": hits, "best_field": f"greatest({nd}, {ad})", "worst_field": f"least({nd}, {ad})",
    }
    return ", ".join(f"round({exprs[f]}, {digits}) AS {f}" if digits else f"{exprs[f]} AS {f}" for f in _FEATURES)


_PAIR_JOIN = "JOIN rec a ON a.source = 1 AND a.num = p.s1 JOIN rec b ON b.source = p.source AND b.num = p.num"
_FEAT = f"""feat AS MATERIALIZED (SELECT p.s1, p.source AS src, p.num, 'S1-' || p.s1 AS s1_id, 'S' || p.source || '-' || p.num AS target_id, fold.fold, coalesce((own.owner = p.s1)::int, 0) AS label, {_feature_sql('least(p.hits, 10) / 10.0::double')}
    FROM topk p {_PAIR_JOIN} JOIN fold ON fold.num = p.s1 LEFT JOIN own ON own.source = p.source AND own.num = p.num WHERE p.s1 IN (SELECT s1 FROM tr))"""

#: the same pairs with features as they are and 0.5 retrieval hits, as a model is scored with
_UNROUNDED = f"""FROM (SELECT p.s1, p.source AS src, p.num, 'S1-' || p.s1 AS s1_id, 'S' || p.source || '-' || p.num AS target_id, {_feature_sql('0.5::double', None)}
    FROM topk p {_PAIR_JOIN} WHERE p.s1 IN (SELECT s1 FROM tr))"""
_TREES = """(-0.25::double + CASE WHEN best_field <= 0.625::double THEN -1.5::double WHEN numeric_agree <= 0.5::double THEN 0.375::double ELSE 1.75::double END
    + CASE WHEN address_token_jaccard <= 0.3125::double THEN -0.125::double ELSE 0.5::double END)"""


_BASE = [_E, _N, _REC]
_BLOCK = [*_BASE, _VALUES, _DF, _RARE, _COMP, _KEYS, _HITS, _EV, _KEPT, _RANK0, _RANKED, _POS, _TOP]
_LABEL = [*_BLOCK, _TRUTH, _FOLD, _FEAT]
_VAL = [*_LABEL, "tv AS (SELECT tc.* FROM tc JOIN fold ON fold.num = tc.s1 WHERE fold.fold = 1)", "vf AS (SELECT * FROM feat WHERE fold = 1)"]
#: only the records that the truth names
_NAMED = [_E, _TRUTH, "en AS MATERIALIZED (SELECT * FROM e WHERE (source = 1 AND num IN (SELECT s1 FROM tp)) OR (source, num) IN (SELECT (source, num) FROM tp))", _N.replace("FROM e)", "FROM en)"), _REC]
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))"
_CRC = f"crct AS MATERIALIZED (SELECT {_CRC_TABLE} AS tab)"


def _crc(id_: str) -> str:
    return f"xor(list_reduce(list_transform(range(1, length({id_}) + 1), lambda j: ascii(substr({id_}, j::bigint, 1))::bigint), lambda c, b: xor(c >> 8, tab[((xor(c, b) & 255) + 1)::bigint]), 4294967295::bigint), 4294967295::bigint)"


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _f05(tp: str, pred: str, true: str) -> str:
    return f"CASE WHEN {true} = 0 THEN CASE WHEN {pred} = 0 THEN 1.0::double ELSE 0.0::double END WHEN {pred} = 0 OR {tp} = 0 THEN 0.0::double ELSE 1.25::double * ({tp}::double / {pred}) * ({tp}::double / {true}) / (0.25::double * ({tp}::double / {pred}) + {tp}::double / {true}) END"


_RULES = {
    "A_exact_name_or_address": "name_exact = 1 OR address_exact = 1",
    "B_manual_fuzzy": "(best_field >= 0.72 AND worst_field >= 0.18) OR best_field >= 0.88",
    "C_character_ngram": "best_field >= 0.82 AND worst_field >= 0.10",
}


def _entities(rule: str) -> str:
    return f"""(SELECT t.s1, coalesce(n_cand, 0) AS n_cand, coalesce(n_pred, 0) AS n_pred, coalesce(n_tp, 0) AS n_tp, coalesce(n_found, 0) AS n_found, n_true::bigint AS n_true FROM tv t LEFT JOIN
        (SELECT s1, count(*) AS n_cand, count(*) FILTER ({rule}) AS n_pred, count(*) FILTER (({rule}) AND label = 1) AS n_tp, count(*) FILTER (label = 1) AS n_found FROM vf GROUP BY s1) p ON p.s1 = t.s1)"""


_SCORED = f"scored AS (SELECT *, {_f05('n_tp', 'n_pred', 'n_true')} AS f05 FROM {_entities(_RULES['B_manual_fuzzy'])})"
_SCAN = f"""sc AS (SELECT s1, label, round(best_field, 3) AS score FROM vf),
    ths AS (SELECT DISTINCT score AS threshold FROM sc UNION ALL SELECT 'Infinity'::double),
    pe AS (SELECT threshold, t.s1, any_value(n_true) AS n_true, count(score) FILTER (score >= threshold) AS n_pred, count(score) FILTER (score >= threshold AND label = 1) AS n_tp
           FROM ths CROSS JOIN tv t LEFT JOIN sc ON sc.s1 = t.s1 GROUP BY threshold, t.s1),
    macro AS (SELECT threshold, round(avg({_f05('n_tp', 'n_pred', 'n_true')}), 6) AS macro_f05 FROM pe GROUP BY threshold)"""

_MISS = ", ".join(_q(m) for m in _MISSING)
_TPAIR = f"FROM tp p {_PAIR_JOIN}"


def _sim(f, name: str, address: str) -> str:
    return _with(_NAMED, f"SELECT p.s1, p.source, p.num, round({f(f'a.{name}', f'b.{name}')}, 6) AS name_value, round({f(f'a.{address}', f'b.{address}')}, 6) AS address_value {_TPAIR}")


def _block(*tags: int) -> str:
    return _with(_BLOCK[:9], f"SELECT tag, s1, source, num, count(*) AS n_keys FROM hits WHERE tag IN ({', '.join(map(str, tags))}) GROUP BY tag, s1, source, num")


def _lists(pairs: str, name: str) -> str:
    return f"""SELECT e.entity_id AS source1_entity_id, coalesce(l.ids, '') AS {name} FROM e LEFT JOIN
        (SELECT s1, string_agg('S' || source || '-' || num, ',' ORDER BY source, num) AS ids FROM {pairs} GROUP BY s1) l ON l.s1 = e.num WHERE e.source = 1"""


def _sampled(part: str) -> str:
    """A part of the chain for a training run: one master record in a hundred, buckets of at most five."""
    return part.replace("AS addr_norm FROM e)", "AS addr_norm FROM e WHERE source > 1 OR num % 100 = 0)").replace("HAVING count(*) <= 20", "HAVING count(*) <= 5")


ORACLE = {
    "ingest_entities": _with([_E], "SELECT * FROM e"),
    "union_targets": _with([_E], "SELECT source, count(*) AS n_rows, count(*) FILTER (name = '') AS no_name FROM e WHERE source > 1 GROUP BY source"),
    "modulus_sample": _with([_E], "SELECT entity_id, num FROM e WHERE source = 1 AND num % 10 = 3"),
    "splitmix_fold": _with([_E, _FOLD], "SELECT num, lpad(upper(to_hex(x::ubigint)), 16, '0') AS hash_hex, (x % 5)::int AS mod5, fold FROM fold"),
    "entity_id_parts": _with([_E], "SELECT entity_id, source, num, 'S' || source || '-' || num AS rendered FROM e WHERE source = 2"),
    "normalize_name": _with([_E, _N], "SELECT entity_id, name_norm FROM n"),
    "normalize_address": _with([_E, _N], "SELECT entity_id, addr_norm FROM n"),
    "token_sets": _with(_BASE, "SELECT entity_id, array_to_string(name_toks, ' ') AS name_toks, array_to_string(addr_toks, ' ') AS addr_toks FROM rec"),
    "trigram_sets": _with(_BASE, "SELECT entity_id, array_to_string(name_grams, ' ') AS name_grams, len(addr_grams)::int AS n_addr_grams FROM rec"),
    "numeric_tokens": _with(_BASE, "SELECT entity_id, array_to_string(addr_nums, ' ') AS addr_nums FROM rec"),
    "postal_tokens": _with(_BASE, r"""SELECT entity_id, array_to_string(list_filter(addr_nums, lambda n: length(n) IN (5, 6)), ' ') AS postal,
        array_to_string(list_sort(list_distinct(regexp_extract_all(addr_norm, '\b(\d{5}(?:-\d{4})?|\d{6})\b', 1))), ' ') AS bounded_postal FROM rec"""),
    "compound_gram_pairs": _with(_BLOCK[:7], "SELECT source, num, tag, count(*) AS n_pairs, min(val) AS first_pair, max(val) AS last_pair FROM comp GROUP BY source, num, tag"),
    "similarity_jaccard": _sim(_jac, "name_toks", "addr_toks"),
    "similarity_dice": _sim(_dice, "name_grams", "addr_grams"),
    "similarity_edit": _sim(_edit, "name_norm", "addr_norm"),
    "similarity_containment": _sim(_contains, "name_norm", "addr_norm"),
    "similarity_length": _sim(_ratio, "name_norm", "addr_norm"),
    **{n: _with(_BLOCK[:5], f"SELECT val, df FROM df WHERE kind = {k}") for k, n in enumerate(("token_df_name", "token_df_address", "gram_df_name", "gram_df_address"), 1)},
    "rare_tokens": _with(_BLOCK[:6], "SELECT source, num, kind, val, df, rank FROM rare WHERE kind <= 2"),
    "rare_grams": _with(_BLOCK[:6], "SELECT source, num, kind, val, df, rank FROM rare WHERE kind >= 3"),
    "block_exact_name": _block(1), "block_exact_address": _block(2), "block_rare_token": _block(3, 4), "block_rare_gram": _block(5, 6), "block_compound": _block(7, 8),
    "evidence_counts": _with(_BLOCK[:10], "SELECT * FROM ev"),
    "keep_candidates": _with(_BLOCK[:11], "SELECT s1, source, num, hits FROM kept"),
    "candidate_rank": _with(_BLOCK[:13], "SELECT s1, source, num, hits, round(name_dice, 6) AS name_dice, round(addr_dice, 6) AS addr_dice, round(rank_score::double, 5) AS rank_score FROM ranked"),
    "candidate_topk": _with(_BLOCK[:14], "SELECT s1, source, num, position FROM pos WHERE position <= 50"),
    "training_candidates": _with([_sampled(x) for x in _BLOCK], "SELECT s1, source, num, hits, position FROM pos WHERE position <= 100"),
    "full_candidate_lists": _with([x.replace("df <= 1000)", "df <= 80000)").replace("df <= 10", "df <= 800") for x in _BLOCK], _lists("topk", "candidate_entity_ids")),
    "candidate_lists": _with(_BLOCK, _lists("topk", "candidate_entity_ids")),
    "candidate_counters": _with([*_BLOCK, _TRUTH], """, lab AS (SELECT p.*, coalesce((own.owner = p.s1)::int, 0) AS label FROM pos p LEFT JOIN own ON own.source = p.source AND own.num = p.num),
        c AS (SELECT count(*) AS pre_pairs, sum(label)::bigint AS pre_true, count(*) FILTER (position <= 50) AS final_pairs, (sum(label) FILTER (position <= 50))::bigint AS positives_found FROM lab)
        SELECT c.*, (SELECT sum(n_true) FROM tc)::bigint AS true_total, round(positives_found::double / (SELECT sum(n_true) FROM tc), 6) AS candidate_recall,
               round(final_pairs::double / (SELECT count(*) FROM rec WHERE source = 1), 6) AS avg_candidates, (SELECT max(n) FROM (SELECT count(*) AS n FROM ev GROUP BY source, num)) AS max_raw_per_target FROM c""").replace("\n, lab AS", ", lab AS"),
    "final_fit_rows": _with(_LABEL, """, m AS (SELECT count(*) FILTER (label = 1)::double AS p, count(*) FILTER (label = 0)::double AS n FROM feat WHERE fold = 0 AND (label = 1 OR num % 4 = 0)),
        r AS (SELECT 'S1-' || o.owner AS s1_id, 'S' || o.source || '-' || o.num AS target_id, 1 AS label FROM own o JOIN rec a ON a.source = 1 AND a.num = o.owner JOIN rec b ON b.source = o.source AND b.num = o.num
              UNION ALL SELECT s1_id, target_id, 0 FROM feat WHERE label = 0)
        SELECT s1_id, target_id, label, 0.5::double AS retrieval_hits, round(CASE WHEN label = 1 THEN m.p ELSE m.n END / count(*) OVER (PARTITION BY label), 6) AS weight FROM r, m""").replace("\n, m AS", ", m AS"),
    "owner_last_wins": _with([_TRUTH], "SELECT source, num, owner FROM own"),
    "label_pairs": _with([*_BLOCK, _TRUTH], "SELECT p.s1, p.source, p.num, coalesce((own.owner = p.s1)::int, 0) AS label FROM topk p LEFT JOIN own ON own.source = p.source AND own.num = p.num"),
    "pair_features": _with(_LABEL, f"SELECT s1_id, target_id, fold, label, {', '.join(_FEATURES)} FROM feat"),
    "all_positive_features": _with(_NAMED, f"SELECT 'S1-' || p.s1 AS s1_id, 'S' || p.source || '-' || p.num AS target_id, 0 AS fold, 1 AS label, {_feature_sql('0.5::double')} FROM (SELECT owner AS s1, source, num FROM own) p {_PAIR_JOIN}"),
    "negative_downsample": _with(_LABEL, "SELECT s1_id, target_id, label, 0.5::double AS retrieval_hits FROM feat WHERE fold = 0 AND (label = 1 OR num % 4 = 0)"),
    "class_weights": _with(_LABEL, "SELECT label, count(*) AS n_rows, CASE WHEN label = 1 THEN count(*)::double ELSE 1000.0::double END AS mass FROM feat WHERE fold = 0 AND (label = 1 OR num % 4 = 0) GROUP BY label"),
    "candidate_stats": _with(_VAL, """, pc AS (SELECT t.s1, n_true, coalesce(c, 0) AS c, coalesce(found, 0) AS found FROM tv t LEFT JOIN (SELECT s1, count(*) AS c, sum(label) AS found FROM vf GROUP BY s1) p ON p.s1 = t.s1)
        SELECT count(*) AS entities, max(c) AS max_candidates, round(avg(c), 6) AS mean_candidates, round(quantile_cont(c::double, 0.5), 6) AS median_candidates, round(quantile_cont(c::double, 0.95), 6) AS p95_candidates,
               round(sum(found)::double / sum(n_true), 6) AS candidate_recall, round(1 - avg(c) / ((SELECT count(*) FROM train_source2) + (SELECT count(*) FROM train_source3)), 6) AS reduction_ratio FROM pc""").replace("\n, pc AS", ", pc AS"),
    "rules_abc_metrics": _with(_VAL, " UNION ALL ".join(f"""SELECT '{name}' AS experiment, round(CASE WHEN sum(n_true) = 0 THEN 0 ELSE sum(n_found)::double / sum(n_true) END, 6) AS candidate_recall, round(CASE WHEN sum(n_pred) = 0 THEN 1 ELSE sum(n_tp)::double / sum(n_pred) END, 6) AS precision, round(CASE WHEN sum(n_true) = 0 THEN 1 ELSE sum(n_tp)::double / sum(n_true) END, 6) AS recall,
        round(avg(f05), 6) AS macro_f05, round(avg(f05) FILTER (n_true = 0), 6) AS singleton_accuracy, round(avg(f05) FILTER (n_true > 0), 6) AS non_singleton_f05, round(avg(n_cand), 6) AS avg_candidates
        FROM (SELECT *, {_f05('n_tp', 'n_pred', 'n_true')} AS f05 FROM {_entities(rule)})""" for name, rule in _RULES.items())),
    "fbeta_by_entity": _with([*_VAL, _SCORED], "SELECT s1, n_cand, n_pred, n_tp, n_true, round(f05, 6) AS f05 FROM scored"),
    "macro_by_country": _with([*_VAL, _SCORED], "SELECT country, count(*) AS entities, round(avg(f05), 6) AS macro_f05 FROM scored JOIN e ON e.source = 1 AND e.num = scored.s1 GROUP BY country"),
    "macro_by_multiplicity": _with([*_VAL, _SCORED], "SELECT n_true, count(*) AS entities, round(avg(f05), 6) AS macro_f05 FROM scored GROUP BY n_true"),
    "threshold_scan": _with([*_VAL, _SCAN], "SELECT threshold, macro_f05 FROM macro"),
    "best_threshold": _with([*_VAL, _SCAN], "SELECT threshold, macro_f05 FROM macro ORDER BY macro_f05 DESC, threshold DESC LIMIT 1"),
    "audit_missing": " UNION ALL ".join(f"SELECT {k} AS source, '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL OR {c} IN ({_MISS})) AS missing FROM train_source{k}" for k in (1, 2, 3) for c in ("entity_id", "business_name", "business_address", "country")),
    "audit_countries": f"SELECT CASE WHEN country IS NULL OR country IN ({_MISS}) THEN '<MISSING>' ELSE country END AS country, count(*) AS n_rows FROM train_source1 GROUP BY 1",
    "match_histogram": "SELECT len(list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> ''))::int AS n_matches, count(*) AS n_rows FROM train_matches GROUP BY 1",
    "origin_classes": """SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 's2_only' WHEN b THEN 's3_only' ELSE 'singleton' END AS origin, count(*) AS n_rows
        FROM (SELECT contains(coalesce(matched_entity_ids, ''), 'S2-') AS a, contains(coalesce(matched_entity_ids, ''), 'S3-') AS b FROM train_matches) GROUP BY 1""",
    "crc_sample": _with([_E, _CRC], f"SELECT entity_id FROM e, crct WHERE source = 1 AND {_crc('entity_id')} % 20 = 0"),
    "audit_duplicate_ids": f"""SELECT 'id' AS what, sum(n - 1)::bigint AS duplicate_rows, count(*) FILTER (n > 1) AS duplicate_values
        FROM (SELECT coalesce({_NUM}, -1) AS v, count(*) AS n FROM train_source1 GROUP BY 1)""",
    "noise_pair_ids": _with([_E, _CRC], f""", ch AS (SELECT DISTINCT source1_entity_id AS s1, list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(replace(x, chr(13), ''))), lambda x: x <> '') AS ids, {_crc('source1_entity_id')} AS crc
              FROM train_matches, crct WHERE source1_entity_id IS NOT NULL AND {_crc('source1_entity_id')} % 2 = 0),
        po AS (SELECT entity_id AS target, country, row_number() OVER (PARTITION BY country ORDER BY source, num) AS slot FROM e WHERE source > 1 QUALIFY slot <= 20000),
        sz AS (SELECT country, count(*) AS size FROM po GROUP BY country)
        SELECT 'positive' AS label, p.s1, p.target FROM (SELECT DISTINCT s1, unnest(ids) AS target FROM ch) p JOIN e t ON t.entity_id = p.target AND t.source > 1 JOIN e m ON m.entity_id = p.s1 AND m.source = 1
        UNION ALL SELECT 'negative', ch.s1, po.target FROM ch JOIN e m ON m.entity_id = ch.s1 AND m.source = 1 JOIN sz ON sz.country = m.country JOIN po ON po.country = m.country AND po.slot = ch.crc % sz.size + 1
        WHERE NOT list_contains(ch.ids, po.target)""").replace("\n, ch AS", ", ch AS"),
    "fixed_logistic_scores": _with(_LABEL, "SELECT s1_id, target_id, round(-4.0::double + " + " + ".join(f"({0.25 * (i % 5) - 0.25})::double * {f}" for i, f in enumerate(_FEATURES)) + f", 6) AS score {_UNROUNDED}"),
    "fixed_tree_scores": _with(_LABEL, f"SELECT s1_id, target_id, round({_TREES}, 6) AS score {_UNROUNDED}"),
    "fixed_model_matches": _with(_LABEL, f""", hit AS (SELECT s1, src AS source, num FROM (SELECT s1, src, num, round({_TREES}, 6) AS score {_UNROUNDED}) WHERE score >= 0.5)
        {_lists("hit", "matched_entity_ids")}""").replace("\n, hit AS", ", hit AS"),
    "reservoir_first_n": """SELECT country, position, source, row_no FROM (SELECT *, cast(row_number() OVER (PARTITION BY country ORDER BY source, row_no) AS int) AS position
        FROM (SELECT 2 AS source, * FROM train_source2 UNION ALL SELECT 3, * FROM train_source3)) WHERE position <= 20000""",
}
