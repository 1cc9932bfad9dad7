"""SQL for the queries that SQL can express, for DuckDB over the same tables.

No SQL is given where the contract needs a fitted model, XXH64 or a tokenizer (op4, op7, op8, op10, op11, pipeline).
The pages of the given tables state no redirects or canonical links, so op2 needs the rules only here; tests
hold the spread over links against brute force.
"""

from patentflow.llm.merkle import FAN, FIELDS
from patentflow.llm.queries import CONTROL_CONVERSATION, CONTROL_TEXT, SHARD_BYTES, TAMPERED_PARTS, URL_RULES
from patentflow.llm.queries import LOWER as _LOWER
from patentflow.llm.queries import UPPER as _UPPER

_RULES = ", ".join(f"('{rule.host}', '{rule.path}', '{rule.verdict}')" for rule in URL_RULES)

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
"""

URL_FILTER = rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULES}),
p AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
fitting AS (
  SELECT n, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, verdict) AS nth
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fitting WHERE nth = 1) USING (n)
"""

# Shards of the given tables end within 24 bits.
SHARDING = f"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(strlen(text), 0) AS bytes,
    lpad(bin(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
prefixes AS (SELECT n, doc_id, bytes, depth, substr(bits, 1, depth) AS shard FROM d, range(0, 25) AS r(depth)),
sums AS (
  SELECT *, sum(bytes) OVER (PARTITION BY depth, shard) AS shard_bytes,
    count(*) OVER (PARTITION BY depth, shard) AS shard_rows
  FROM prefixes),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY depth) AS nth
  FROM sums WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1)
SELECT doc_id, CAST(bytes AS BIGINT) AS bytes, shard, CAST(depth AS INTEGER) AS depth,
  CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows, shard_bytes > {SHARD_BYTES} AS oversized
FROM leaves WHERE nth = 1
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    ('0x' || substr(md5(concat_ws(':', '0', CAST(doc_id AS VARCHAR))), 1, 15))::BIGINT AS draw
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
weighted AS (
  SELECT *, 3 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sizes),
ordered AS (
  SELECT *, row_number() OVER o AS nth, CAST(sum(source_size) OVER () AS BIGINT) AS total,
    CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS held,
    CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_weight
  FROM weighted WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
levels AS (SELECT arg_min((total - held)::DOUBLE / open_weight, nth) AS level FROM ordered
  WHERE (total - held)::DOUBLE / open_weight * weight <= cap),
targets AS (
  SELECT source, source_size, least(weight * coalesce(level, 1e300), cap::DOUBLE) AS target FROM weighted, levels),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT d.*, source_size, target, whole, target - whole * source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id) AS upto,
    sum(size) OVER (PARTITION BY d.source, draw, doc_id) AS own
  FROM d JOIN plans ON d.source IS NOT DISTINCT FROM plans.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (whole + CASE WHEN rest > 0 AND upto - own / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""


def _escaped(column: str) -> str:
    return rf"replace(replace(replace(replace({column}, '\', '\b'), '<', '\l'), ':', '\c'), '#', '\h')"


# A turn does not read back if it holds what ends a turn or a role, or what reads as an escape; what opens a turn is
# escaped as well.
CHAT_FORMAT = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {CONTROL_CONVERSATION}, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT {CONTROL_CONVERSATION}, 1, 'assistant', '{CONTROL_TEXT}'),
checked AS (
  SELECT *, contains(text, '</turn>') OR contains(role, '</turn>') OR contains(role, ': ')
    OR contains(text, chr(10) || '### ') OR contains(role, chr(10) || '### ')
    OR regexp_matches(text, '\\[blch]') OR regexp_matches(role, '\\[blch]') AS is_odd
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + CASE WHEN is_odd THEN length({_escaped('role')}) + length({_escaped('text')})
    ELSE length(role) + length(text) END) AS BIGINT) AS formatted_chars
FROM checked GROUP BY conv_id
"""

VECTOR_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, len(embedding) AS dim FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v AS a JOIN v AS b
  ON a.vec_id <> b.vec_id AND a.dim = b.dim AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach AS r JOIN links AS l ON r.v = l.u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u),
least_of AS (SELECT u, min(v) AS least_v FROM reach GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least_v, vec_id)) AS component_id,
  least(vec_id, coalesce(least_v, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON counts.u = vec_id LEFT JOIN least_of ON least_of.u = vec_id
"""

# Levels that the trees of the given tables stay within: a million leaves a source, 256 sources.
SOURCE_LEVELS, TOP_LEVELS = 5, 2


def _crc32(text: str) -> str:
    """Bit by bit; polynomial and start are those of zlib."""
    step = "xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda r, i: {step})"
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ord(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {byte}), 4294967295)"


def _leaf(text: str) -> str:
    values = [f"CAST({name} AS VARCHAR)" if name != "text" else text for name in FIELDS]
    framed = [f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END" for value in values]
    return f"sha256({' || '.join(framed)})"


def _tree(name: str, levels: int) -> str:
    """Nodes {name}0, {name}1, ... by level, the single ones left, and what stands beside each node."""
    parts = []
    for k in range(levels):
        run = f"FROM {name}{k} WHERE size > 1 GROUP BY tree, idx // {FAN}"
        parts.append(
            f"{name}{k + 1} AS (SELECT tree, idx // {FAN} AS idx, sha256(string_agg(digest, '' ORDER BY idx)) AS digest,"
            f" (any_value(size) + {FAN - 1}) // {FAN} AS size {run})"
        )
        parts.append(
            f"{name}beside{k} AS (SELECT a.tree, a.idx,"
            " coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,"
            " coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r"
            f" FROM {name}{k} AS a JOIN {name}{k} AS b ON a.tree = b.tree AND a.idx // {FAN} = b.idx // {FAN}"
            " WHERE a.size > 1 GROUP BY a.tree, a.idx)"
        )
    ends = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE size = 1" for k in range(levels + 1))
    return ",\n".join([*parts, f"{name}ends AS ({ends})"])


def _climb(name: str, levels: int, tree: str, idx: str) -> str:
    """Joins what stands beside a node at each level."""
    return " ".join(
        f"LEFT JOIN {name}beside{k} AS {name}{k}b ON {name}{k}b.tree = {tree} AND {name}{k}b.idx = {idx} // {FAN**k}"
        for k in range(levels)
    )


def _merkle() -> str:
    steps = [f"s{k}b" for k in range(SOURCE_LEVELS)] + [f"t{k}b" for k in range(TOP_LEVELS)]
    proof = " || ".join(f"coalesce({at}.l || {at}.r, '')" for at in steps)
    folds, before = [], "f"
    for k, at in enumerate(steps):
        folds.append(f"f{k} AS (SELECT * EXCLUDE f, CASE WHEN l{k} IS NULL THEN f ELSE sha256(l{k} || f || r{k}) END AS f FROM {before})")
        before = f"f{k}"
    sides = ", ".join(f"{at}.l AS l{k}, {at}.r AS r{k}" for k, at in enumerate(steps))
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % {TAMPERED_PARTS} = 0 AND text IS NOT NULL THEN {_leaf(lowered)} END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS size FROM d),
s0 AS (SELECT tree, idx, leaf AS digest, size FROM leaves),
{_tree("s", SOURCE_LEVELS)},
tops AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS size FROM sends),
t0 AS (SELECT 'top' AS tree, idx, digest, size FROM tops),
{_tree("t", TOP_LEVELS)},
f AS (
  SELECT doc_id, leaf, tops.digest AS subroot, (SELECT digest FROM tends) AS root, {proof} AS proof, {sides},
    coalesce(tampered, leaf) AS f
  FROM leaves JOIN tops USING (tree)
  {_climb("s", SOURCE_LEVELS, "leaves.tree", "leaves.idx")} {_climb("t", TOP_LEVELS, "'top'", "tops.idx")}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM {before}
"""


FILL_IN_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens
  FROM documents),
draws AS (
  SELECT *, len(tokens) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(tokens) + 1) AS a,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(tokens) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
parts AS (
  SELECT *, array_to_string(tokens[1:least(a, b)], '') AS prefix,
    array_to_string(tokens[least(a, b) + 1:greatest(a, b)], '') AS middle,
    array_to_string(tokens[greatest(a, b) + 1:], '') AS suffix
  FROM draws)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

ORACLES: dict[str, str] = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op2_url_filter": URL_FILTER,
    "op3_sharding": SHARDING,
    "op5_mixing": MIXING,
    "op6_chat_format": CHAT_FORMAT,
    "op9_vector_dedup": VECTOR_DEDUP,
    "op12_merkle": _merkle(),
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
