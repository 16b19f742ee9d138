"""SQL twins (DuckDB) of the training-data queries that SQL can express."""

from __future__ import annotations

from fractions import Fraction

from curatrix.llm.names import IMAGE_EXTENSIONS, PLACEHOLDERS, SPLIT_SPELLINGS
from curatrix.llm.queries import RATE, SEED
from curatrix.llm.sample import HALF, OWN_NUMBER, PRIME, round_keys


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s ]+|[\s ]+$', '', 'g')"


def _id(x: str) -> str:
    return rf"nullif(regexp_replace(lower({_trim(x)}), '\.({'|'.join(IMAGE_EXTENSIONS)})$', ''), '')"


def _word(x: str) -> str:
    return rf"nullif(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', '', 'g'), '')"


def _group(dataset: str, group: str) -> str:
    bare = _trim(rf"regexp_replace(regexp_replace(regexp_replace(lower({_trim(group)}), '^.*[/\\]', ''), '#t=.*$', ''), '\.rf\.[0-9a-z]+\.[a-z0-9]+$', '')")
    return f"CASE WHEN NOT (lower({_trim(group)}) IN ({_list(PLACEHOLDERS)}) OR {bare} IN ({_list(PLACEHOLDERS)})) THEN {_word(dataset)} || '|' || {bare} END"


def _split(x: str) -> str:
    return "CASE " + " ".join(f"WHEN lower({_trim(x)}) IN ({_list(v)}) THEN '{k}'" for k, v in SPLIT_SPELLINGS.items()) + " END"


def _feistel(source: str) -> str:
    """CTEs r0 .. rN over ``source(key)``, and ``chosen(key)``."""
    top, rest = divmod(int(Fraction(str(RATE)) * HALF * HALF), HALF)
    own = f"regexp_matches(key, '{OWN_NUMBER}')"
    lines = [
        f"d0 AS (SELECT key, CASE WHEN {own} THEN right(key, 16) ELSE sha256(key) END AS d, CASE WHEN {own} THEN ('0x' || substr(sha256(regexp_extract(key, '{OWN_NUMBER}', 1)), 1, 7))::BIGINT ELSE 0 END AS t FROM {source})",
        "r0 AS (SELECT key, t, ('0x' || substr(d, 1, 8))::BIGINT AS h, ('0x' || substr(d, 9, 8))::BIGINT AS l FROM d0)",
    ]
    keys = round_keys(SEED)
    for i, (a, b, c) in enumerate(keys):
        lines.append(f"m{i} AS (SELECT key, t, h, l, (l * {a} + {c} + t) % {PRIME} AS m FROM r{i})")
        lines.append(f"r{i + 1} AS (SELECT key, t, l AS h, xor(h, (xor(m, m >> 15) * {b}) % {PRIME}) AS l FROM m{i})")
    lines.append(f"chosen AS (SELECT key FROM r{len(keys)} WHERE h < {top} OR (h = {top} AND l < {rest}))")
    return ",\n".join(lines)


_P1_ROWS = f"""rows1 AS (SELECT {_id("canonical_id")} AS record_key, canonical_id, {_group("source_dataset", "source_group")} AS grp,
  manifest_version FROM baseline_split_manifest)"""


def _p1(unit: str) -> str:
    return f"""WITH {_P1_ROWS},
u AS (SELECT *, {unit} AS unit_key FROM rows1 WHERE record_key IS NOT NULL),
k AS (SELECT DISTINCT unit_key AS key FROM u),
{_feistel("k")}
SELECT record_key, min(unit_key) AS unit_key, count(DISTINCT canonical_id) AS spellings, count(*) AS "rows", min(manifest_version) AS first_version
FROM u WHERE unit_key IN (SELECT key FROM chosen) GROUP BY record_key"""


_P1_GROWTH = f"""WITH {_P1_ROWS},
f AS (SELECT DISTINCT record_key AS key FROM rows1 WHERE record_key IS NOT NULL),
{_feistel("f")},
drawn AS (SELECT DISTINCT v, record_key FROM rows1, (VALUES (1), (2), (3)) t(v) WHERE coalesce(manifest_version, 1) <= v AND record_key IN (SELECT key FROM chosen)),
now AS (SELECT v, count(*) AS selected FROM drawn GROUP BY 1),
old AS (SELECT a.v + 1 AS v, count(b.record_key) AS kept, count(*) - count(b.record_key) AS lost FROM drawn a LEFT JOIN drawn b ON b.v = a.v + 1 AND b.record_key = a.record_key GROUP BY 1)
SELECT v::INTEGER AS manifest_version, selected AS selected_records, coalesce(kept, 0) AS kept_records, coalesce(lost, 0) AS lost_records FROM now LEFT JOIN old USING (v)"""

_P2 = f"""WITH RECURSIVE sides AS (SELECT {_group("source_dataset_a", "source_group_a")} AS a, {_group("source_dataset_b", "source_group_b")} AS b,
  coalesce(lower({_trim("link_status")}) = 'confirmed', false) AS yes, reviewed_at FROM group_links),
pairs AS (SELECT least(a, b) AS u, greatest(a, b) AS v, yes, reviewed_at FROM sides WHERE a <> b),
ranked AS (SELECT *, row_number() OVER (PARTITION BY u, v ORDER BY reviewed_at DESC NULLS LAST, yes) AS k FROM pairs),
both_ways AS (SELECT u, v FROM ranked WHERE k = 1 AND yes UNION SELECT v, u FROM ranked WHERE k = 1 AND yes),
reach AS (SELECT u AS grp, u AS other FROM both_ways UNION SELECT r.grp, e.v FROM reach r JOIN both_ways e ON e.u = r.other),
units AS (SELECT grp, min(other) AS unit FROM reach GROUP BY grp),
recs AS (SELECT canonical_id, {_group("source_dataset", "source_group")} AS grp, {_split("avax_split")} AS split
  FROM baseline_split_manifest WHERE lower({_trim("split_status")}) = 'included'),
placed AS (SELECT r.*, coalesce(t.unit, r.grp) AS unit FROM recs r LEFT JOIN units t USING (grp) WHERE r.grp IS NOT NULL),
torn AS (SELECT unit, count(DISTINCT grp) AS groups, count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'val') AS val_rows,
  count(*) FILTER (split = 'test') AS test_rows FROM placed GROUP BY unit HAVING count(DISTINCT split) > 1)
"""

_P2_INVARIANTS = f"""WITH n AS (SELECT count(DISTINCT {_id("canonical_id")}) AS n FROM baseline_split_manifest WHERE lower({_trim("split_status")}) = 'included'),
q AS (SELECT split_name, target_share, n, n * target_share / (SELECT sum(target_share) FROM split_targets) AS exact FROM split_targets, n),
f AS (SELECT *, floor(exact)::BIGINT AS whole, row_number() OVER (ORDER BY exact - floor(exact) DESC, split_name) AS k FROM q)
SELECT split_name, target_share, whole + CASE WHEN k <= n - (SELECT sum(whole) FROM f) THEN 1 ELSE 0 END AS records, 0::BIGINT AS torn_units, 0::BIGINT AS torn_related FROM f"""

_P3 = rf"""WITH asks AS (SELECT negative_batch, target_field, target_value, greatest(min_count, round(target_share * sample_size)::INTEGER) AS ask FROM negative_targets),
imgs AS (SELECT NegativeBatch AS b, {_id("regexp_replace(ImageID, '\\s+', '', 'g')")} AS image, {_word("CandidateCategory")} AS category,
  regexp_split_to_array(coalesce(MatchedClasses, ''), '[;,|/]') AS classes
  FROM accepted_negatives_batch2_metadata WHERE regexp_replace(lower(ReviewStatus), '\s+', '', 'g') = 'accepted_negative'),
cls AS (SELECT b, image, regexp_replace(lower(c), '\s+', '', 'g') AS c FROM (SELECT b, image, unnest(classes) AS c FROM imgs)),
have AS (SELECT a.negative_batch, a.target_field, a.target_value, i.image FROM asks a JOIN imgs i ON i.b = a.negative_batch
    AND a.target_field = 'CandidateCategory' AND levenshtein(i.category, {_word("a.target_value")}) <= 1
  UNION SELECT a.negative_batch, a.target_field, a.target_value, c.image FROM asks a JOIN cls c ON c.b = a.negative_batch
    AND a.target_field = 'MatchedClasses' AND c.c = regexp_replace(lower(a.target_value), '\s+', '', 'g')),
supply AS (SELECT a.negative_batch, a.target_field, a.target_value, max(a.ask) AS ask, count(DISTINCT h.image) AS supply FROM asks a LEFT JOIN have h USING (negative_batch, target_field, target_value)
  GROUP BY ALL)
"""

_P3_INVARIANTS = rf"""WITH t AS (SELECT negative_batch, max(sample_size) AS size FROM negative_targets GROUP BY 1),
a AS (SELECT NegativeBatch AS negative_batch, count(DISTINCT {_id("regexp_replace(ImageID, '\\s+', '', 'g')")}) AS accepted FROM accepted_negatives_batch2_metadata
  WHERE regexp_replace(lower(ReviewStatus), '\s+', '', 'g') = 'accepted_negative' GROUP BY 1)
SELECT negative_batch, least(size, accepted)::BIGINT AS sample_rows, least(size, accepted)::BIGINT AS distinct_images, 0::BIGINT AS not_accepted, 0::BIGINT AS missed_floors FROM t JOIN a USING (negative_batch)"""

_P4 = f"""WITH recs AS (SELECT DISTINCT canonical_id AS id, {_split("avax_split")} = 'train' AS train FROM baseline_split_manifest
  WHERE lower({_trim("split_status")}) = 'included' AND {_split("avax_split")} IS NOT NULL),
fp AS (SELECT DISTINCT r.id, r.train, lower(pixel_sha256) AS pixels, ('0x' || lower(phash))::UBIGINT AS p, ('0x' || lower(dhash))::UBIGINT AS d,
  CASE WHEN width > 0 AND height > 0 THEN width::DOUBLE / height END AS aspect FROM recs r JOIN fingerprints f ON f.canonical_id = r.id),
pairs AS (SELECT a.id AS x, b.id AS y, 'id' AS kind FROM recs a JOIN recs b ON {_id("a.id")} = {_id("b.id")} WHERE NOT a.train AND b.train
  UNION SELECT a.id, b.id, 'pixels' FROM fp a JOIN fp b ON a.pixels = b.pixels WHERE NOT a.train AND b.train
  UNION SELECT a.id, b.id, 'near' FROM fp a JOIN fp b ON NOT a.train AND b.train AND bit_count(xor(a.p, b.p)) <= 8 AND bit_count(xor(a.d, b.d)) <= 10
    AND abs(a.aspect - b.aspect) / greatest(a.aspect, b.aspect) <= 0.15)
"""

_P4_REPORT = f"""{_P4}, w AS (SELECT DISTINCT canonical_id AS id, {_split("avax_split")} AS split, coalesce({_word("source_dataset")}, '(missing)') AS source
  FROM baseline_split_manifest WHERE lower({_trim("split_status")}) = 'included' AND {_split("avax_split")} IS NOT NULL)
SELECT e.split AS avax_split, e.source AS source_dataset, t.source AS train_source, kind, count(*) AS pairs, count(DISTINCT x) AS eval_records
FROM pairs JOIN w e ON e.id = x AND e.split <> 'train' JOIN w t ON t.id = y AND t.split = 'train' WHERE x <> y GROUP BY ALL"""

# the level is where what the sources can give, each up to level * weight, adds up to what is wanted: it is the largest of the candidates
_P6_PLAN = f"""WITH t AS (SELECT source, {_word("source")} AS k, target_weight AS w, max_repeats AS m FROM mix_targets),
d AS (SELECT {_word("source")} AS k, coalesce(length(text), 0) AS n FROM documents), c AS (SELECT k, count(*) AS documents, sum(n)::BIGINT AS tokens FROM d WHERE k IN (SELECT k FROM t) GROUP BY 1),
r AS (SELECT t.source, w, coalesce(documents, 0) AS documents, coalesce(tokens, 0) AS tokens, coalesce(tokens, 0) * m AS most, w * (SELECT sum(tokens) FROM c) AS wanted FROM t LEFT JOIN c USING (k)),
fixed AS (SELECT x.source, x.most / x.w AS need, ((SELECT sum(wanted) FROM r) - coalesce(sum(y.most) FILTER (y.most / y.w < x.most / x.w OR (y.most / y.w = x.most / x.w AND y.source < x.source)), 0))
  / sum(y.w) FILTER (y.most / y.w > x.most / x.w OR (y.most / y.w = x.most / x.w AND y.source >= x.source)) AS factor FROM r x, r y WHERE x.w > 0 AND y.w > 0 GROUP BY x.source, x.most, x.w),
lev AS (SELECT max(factor) AS level FROM fixed)
SELECT source, documents, tokens, round(wanted, 3) AS wanted, round(CASE WHEN w > 0 THEN least(most, coalesce(level * w, most)) ELSE 0 END, 3) AS planned, most < wanted AS falls_short FROM r, lev"""

_P7 = r"""WITH t AS (SELECT doc_id, coalesce(nullif(regexp_extract(lower(trim(lang)), '^([a-z]{2})([-_].*)?$', 1), ''), 'und') AS lang_key, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, lang_key, len(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS words, length(regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g')) AS letters,
  length(regexp_replace(text, '[ \t\n\x0B\f\r]+', '', 'g')) AS filled, len(regexp_extract_all(text, '[^ \t\n\x0B\f\r][^\n]*')) AS lines,
  len(regexp_extract_all(text, '[.!?;:…]["''”’»)\]]*[ \t\r]*(?:\n|\z)')) AS ended FROM t)
SELECT doc_id, lang_key, words, CASE WHEN words > 0 THEN letters / words ELSE 0 END AS mean_word_length,
  CASE WHEN filled > 0 THEN (filled - letters) / filled ELSE 0 END AS symbol_ratio, CASE WHEN lines > 0 THEN least(1, ended / lines) ELSE 0 END AS ended_lines FROM c"""

_P7_SCORES = f"""WITH s AS ({_P7}),
r AS (SELECT *, cume_dist() OVER (PARTITION BY lang_key ORDER BY words) AS wl, cume_dist() OVER (PARTITION BY lang_key ORDER BY words DESC) AS wh,
  cume_dist() OVER (PARTITION BY lang_key ORDER BY mean_word_length) AS ml, cume_dist() OVER (PARTITION BY lang_key ORDER BY mean_word_length DESC) AS mh,
  cume_dist() OVER (PARTITION BY lang_key ORDER BY symbol_ratio DESC) AS sh, cume_dist() OVER (PARTITION BY lang_key ORDER BY ended_lines) AS el FROM s)
SELECT doc_id, lang_key, words, mean_word_length, symbol_ratio, ended_lines,
  round(-ln(least(1, 2 * least(wl, wh))) - ln(least(1, 2 * least(ml, mh))) - ln(sh) - ln(el), 6) AS score FROM r"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_sample": _p1("record_key"),
        "p1_group_sample": _p1("coalesce(grp, record_key)"),
        "p1_growth": _P1_GROWTH,
        "p2_found": _P2 + "SELECT DISTINCT canonical_id FROM placed WHERE unit IN (SELECT unit FROM torn) AND canonical_id IS NOT NULL",
        "p2_torn_relations": _P2 + "SELECT * FROM torn",
        "p2_invariants": _P2_INVARIANTS,
        "p2_split_report": f"SELECT split_name, target_share, records, round(records / (SELECT n FROM (SELECT sum(records) AS n FROM ({_P2_INVARIANTS}))), 6) AS share FROM ({_P2_INVARIANTS})",
        "p3_found": _P3 + "SELECT negative_batch, target_field, target_value FROM supply WHERE supply < ask",
        "p3_supply": _P3 + "SELECT * FROM supply",
        "p3_invariants": _P3_INVARIANTS,
        "p4_found": _P4 + "SELECT DISTINCT least(x, y) AS canonical_id_a, greatest(x, y) AS canonical_id_b FROM pairs WHERE x <> y",
        "p4_report": _P4_REPORT,
        "p6_plan_by_length": _P6_PLAN,
        # every source misses or passes its limit by a factor of 1.4 in any usual tokenizer, so characters decide alike
        "p6_found": f"SELECT source FROM ({_P6_PLAN}) WHERE falls_short",
        "p7_basic": _P7,
        "p7_basic_scores": _P7_SCORES,
    }
