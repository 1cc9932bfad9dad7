"""The registered queries as DuckDB SQL, written independently of the Spark expressions."""

from patentflow.plans.corpus import KNOWN_SQL, PATENTS_SQL
from patentflow.plans.event_oracles import ORACLES as EVENT_ORACLES
from patentflow.schemas import CODE_LISTS, CODE_SPECS, TRAIN_COLS, CodeSpec, features_of, lists_of


def _tags(spec: CodeSpec) -> str:
    value = f"split_part(split_part(i, '<{spec.tag}>', 2), '</{spec.tag}>', 1)"
    value = f"CASE WHEN contains(i, '</{spec.tag}>') THEN {value} ELSE '' END"
    return f"list_filter(list_transform(items, lambda i: {value}), lambda v: v <> '')"


def _distinct(values: str) -> str:
    return f"list_filter({values}, lambda x, i: list_position({values}, x) = i)"


def _pad(values: str, length: int, filler: str) -> str:
    fillers = ", ".join([f"'{filler}'"] * length)
    return f"list_slice(list_concat({values}, [{fillers}]), 1, {length})"


def _clean(column: str) -> str:
    text = f"replace(replace({column}, chr(10), ' '), chr(13), ' ')"
    text = f"replace(replace({text}, '\\n', ' '), '<br/>', '')"
    return f"trim(replace(replace({text}, '<![CDATA[', ''), ']]>', ''))"


def _ascii(column: str) -> str:
    return f"strlen({column}) = length({column})"


_RAW_CODES = ", ".join(f"{_tags(s)} AS {s.name}" for s in CODE_SPECS)
_LISTS = ", ".join(f"{_pad(_distinct(s.name), s.length, s.pad)} AS {s.name}" for s in CODE_SPECS)
_SCALARS = ", ".join(
    f"{s.name}[{i + 1}] AS {s.prefix}_{i}" for s in CODE_SPECS for i in range(s.length)
)
_JOINED = ", ".join(f"array_to_string({name}, ',') AS {name}" for name in CODE_LISTS)

# Steps that queries build on; each one may use those above it.
_STEPS = {
    "patents": PATENTS_SQL,
    "known": KNOWN_SQL,
    "fields": """
        SELECT file_name,
          split_part(split_part(raw_txt, 'id="title_en">', 2), '</invention-title>', 1) AS title,
          split_part(replace(split_part(split_part(split_part(raw_txt, '<abstract', 2), '<p', 2),
            '</p>', 1), '<br/>', ''), '>', 2) AS abstract,
          substr(split_part(split_part(raw_txt, '<document-id>', 2), '<date>', 2), 1, 4) AS "year",
          CASE WHEN contains(raw_txt, '</classifications-ipcr>')
            THEN string_split(split_part(split_part(raw_txt, '<classifications-ipcr>', 2),
              '</classifications-ipcr>', 1), '</classification-ipcr>')
            ELSE [] END AS items
        FROM patents""",
    "tagged": f'SELECT file_name, title, abstract, "year", {_RAW_CODES} FROM fields',
    "codes": f'SELECT file_name, title, abstract, "year", {_LISTS} FROM tagged',
    "features": f"SELECT file_name, {_SCALARS} FROM codes",
    "english": f"""
        SELECT file_name, {_clean('title')} AS title, {_clean('abstract')} AS abstract, "year",
          {", ".join(CODE_LISTS)}
        FROM codes WHERE abstract <> '' AND title <> ''
          AND {_ascii(_clean('abstract'))} AND {_ascii(_clean('title'))}""",
    "tokens": """
        SELECT file_name, list_filter(string_split(trim(upper(regexp_replace(abstract || abstract,
          '[.,\\[\\]()]', ' ', 'g'))), ' '), lambda w: w NOT IN
          ('THE', 'A', 'OF', 'TO', 'AND', 'IN', 'IS', 'AN', 'FOR', 'WITH', 'IF')) AS tokens
        FROM english""",
    "counts": """
        SELECT word, count(*) AS n
        FROM (SELECT replace(unnest(tokens), '"', '') AS word FROM tokens) GROUP BY word""",
    "named": "SELECT *, split_part(file_name, '/', 2) AS base_name FROM patents",
    "others": "SELECT file_name, raw_txt FROM named WHERE base_name NOT IN (SELECT base_name FROM known)",
    "first_2000": "SELECT file_name FROM others ORDER BY file_name LIMIT 2000",
    "energy": """
        SELECT file_name, coalesce(classes[1] >= '01' AND classes[1] < '30', false) AS is_energy FROM codes""",
    "positives": "SELECT file_name, raw_txt FROM named WHERE base_name IN (SELECT base_name FROM known)",
}


def _dictionary(lists: list[str], rows: str = "codes") -> str:
    values = " UNION ALL ".join(f"SELECT unnest({name}) AS value FROM {rows}" for name in lists)
    return f"""
        SELECT value, cast(row_number() OVER (ORDER BY value) - 1 AS int) AS id
        FROM (SELECT DISTINCT value FROM ({values}))"""


_STEPS["positive_codes"] = "SELECT * FROM codes WHERE file_name IN (SELECT file_name FROM positives)"
for _name in ("categorical", "numeric"):
    _STEPS[_name] = _dictionary(lists_of(_name), "positive_codes")


def _lookup(kind: str, name: str) -> str:
    return f"coalesce((SELECT id FROM {kind} WHERE value = features.{name}), -1)"


def _encoded(cast_to: str) -> str:
    kind = {n: k for k in ("categorical", "numeric") for n in features_of(k)}
    ids = ", ".join(f"cast({_lookup(kind[n], n)} AS {cast_to}) AS {n}" for n in TRAIN_COLS)
    return f"SELECT file_name, {ids} FROM features"


def _with(body: str) -> str:
    steps = ", ".join(f"{name} AS ({sql})" for name, sql in _STEPS.items())
    return f"WITH {steps} {body}"


_BODIES = {
    "extract_abstract": "SELECT file_name, abstract FROM fields",
    "extract_full_abstract": """
        SELECT file_name, regexp_replace(regexp_replace(split_part(split_part(split_part(raw_txt, '<abstract', 2),
          '<p', 2), '</p>', 1), '^[^>]*>?', ''), '<[^>]*>', '', 'g') AS abstract FROM patents""",
    "extract_title": "SELECT file_name, title FROM fields",
    "extract_year": 'SELECT file_name, "year" FROM fields',
    "extract_patent": f'SELECT file_name, title, abstract, "year", {_JOINED} FROM english',
    "ipc_items": """
        SELECT file_name, cast(len(items) AS int) AS n_items,
          array_to_string(items, ',') AS items FROM fields""",
    "ipc_features": f"SELECT file_name, {_JOINED} FROM codes",
    "array_pad_truncate": f"""
        SELECT file_name, cast(len({_distinct('classes')}) AS int) AS n_classes,
          array_to_string({_pad(_distinct('classes'), 2, '-1')}, ',') AS classes_2,
          array_to_string({_pad(_distinct('sections'), 4, '0A')}, ',') AS sections_4 FROM tagged""",
    "ipc_feature_columns": "SELECT * FROM features",
    "text_clean": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
    "filter_nonempty": """
        SELECT file_name, title, abstract FROM fields WHERE abstract <> '' AND title <> ''""",
    "filter_ascii": """
        SELECT file_name, title, abstract FROM fields
        WHERE NOT regexp_matches(abstract, '[^\\x00-\\x7F]')
          AND NOT regexp_matches(title, '[^\\x00-\\x7F]')""",
    "str_list_parse": f"SELECT file_name, {_JOINED} FROM codes",
    "tokens_list": """
        SELECT file_name, cast(len(tokens) AS int) AS n_tokens,
          array_to_string(tokens, ',') AS tokens FROM tokens""",
    "token_list_parse": """
        SELECT file_name, cast(len(t) AS int) AS n_tokens, array_to_string(t, ',') AS tokens
        FROM (SELECT file_name, string_split(replace(replace(replace(replace(array_to_string(tokens, ','),
          '[', ''), ']', ''), ' ', ''), '"', ''), ',') AS t FROM tokens)""",
    "agg_word_count": "SELECT word, n FROM counts",
    "agg_count_merge": "SELECT word, n FROM counts",
    "agg_word_topk": "SELECT word, n FROM counts WHERE word <> '' ORDER BY n DESC, word LIMIT 1000",
    "sort_counts_asc": "SELECT word, n FROM counts ORDER BY n, word",
    "agg_counts": """
        SELECT count(*) AS n_docs,
          count(*) FILTER (base_name IN (SELECT base_name FROM known)) AS n_positive,
          count(*) FILTER (base_name NOT IN (SELECT base_name FROM known)) AS n_other FROM named""",
    "agg_sketch_merge": """
        SELECT folder, count(*) AS n_words, count(DISTINCT word) AS exact, true AS is_close, true AS is_same FROM (
          SELECT unnest([split_part(file_name, '/', 1), 'all']) AS folder, word
          FROM (SELECT file_name, unnest(tokens) AS word FROM tokens)) GROUP BY folder""",
    "agg_sketch_topk": """
        SELECT word, count(*) AS n, true AS is_close FROM (SELECT unnest(tokens) AS word FROM tokens)
        GROUP BY word ORDER BY n DESC, word LIMIT 20""",
    "sink_count_map": "SELECT word, n FROM counts WHERE word <> '' ORDER BY n DESC, word LIMIT 1000",
    "src_filelist_parse": """
        SELECT base_name, true AS kept FROM named UNION ALL SELECT url, false FROM pages""",
    "join_semi_positive": "SELECT file_name, raw_txt FROM positives",
    "join_anti_negative": "SELECT file_name, raw_txt FROM others",
    "first_negatives": "SELECT file_name FROM others ORDER BY file_name LIMIT 20",
    "label_union": f"""
        SELECT file_name, target, {_JOINED} FROM codes JOIN (
          SELECT file_name, 0 AS target FROM positives
          UNION ALL SELECT file_name, 1 FROM first_2000) USING (file_name)""",
    "split_train_test": """
        SELECT file_name,
          cast('0x' || substr(md5(file_name), 1, 8) AS bigint) % 4 = 0 AS is_test FROM patents""",
    "sample_shuffle": "SELECT doc_id, NULL::boolean AS is_shuffled FROM documents UNION ALL SELECT NULL, true",
    "dict_categorical": _dictionary(lists_of("categorical")),
    "dict_numeric": _dictionary(lists_of("numeric")),
    "encode_codes": _encoded("int"),
    "ml_features": _encoded("double"),
    "ml_accuracy": """
        SELECT count(*) AS n_rows, true AS is_accurate FROM (
          SELECT file_name FROM energy WHERE is_energy
          UNION ALL (SELECT file_name FROM energy WHERE NOT is_energy ORDER BY file_name LIMIT 2000))
        WHERE cast('0x' || substr(md5(file_name), 1, 8) AS bigint) % 4 = 0""",
    "ml_score": "SELECT file_name, true AS agrees FROM english UNION ALL SELECT 'all', true",
    "ml_energy": "SELECT unnest(['outside', 'other', 'missing']) AS kind, 0::bigint AS n",
    "proj_rename": 'SELECT doc_id AS "number", source AS folder FROM documents',
    "proj_row_id": "SELECT count(*) AS n_rows, count(*) AS n_ids FROM documents",
    "src_archive_unpack": "SELECT file_name, raw_txt FROM patents",
    "src_archive_errors": "SELECT 'text-' || doc_id AS archive FROM documents",
    "src_archive_format": "SELECT file_name, raw_txt FROM patents",
    "src_archive_files": "SELECT file_name, raw_txt FROM patents",
    "src_archive_damage": """
        SELECT doc_id, CAST([1, 1, 2, 2, 0, 3][doc_id % 6 + 1] AS bigint) AS n_members,
          CAST(doc_id % 6 < 5 AS bigint) AS n_errors FROM documents""",
    "stream_archives": f"""
        SELECT file_name, title, abstract, "year", cast(doc_id % 2 AS int) AS batch, {_JOINED}
        FROM english JOIN (SELECT file_name, doc_id FROM patents) USING (file_name)""",
    "src_unreadable_parts": """
        SELECT doc_id, text, lang, source, n_chars, NULL::boolean AS is_told FROM documents
        WHERE coalesce(doc_id % 4 = 3, true) UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, true""",
    "sink_parquet_roundtrip": 'SELECT file_name, title, abstract, "year" FROM english',
    "sink_bounded_files": "SELECT count(*) AS n_rows, 7::bigint AS largest, true AS is_split FROM documents",
    "sink_if_any": 'SELECT file_name, true AS "any", false AS "none" FROM english',
    "sink_partitioned_by_date": """
        SELECT file_name, title, abstract, "year", '20240131' AS ex_date FROM english""",
    "sink_wordcount_roundtrip": "SELECT word, n FROM counts",
}

ORACLES = {name: _with(body) for name, body in _BODIES.items()} | EVENT_ORACLES
