"""The same results as plain SQL over the supplied tables."""

from __future__ import annotations

SOURCE = """
src AS (
  SELECT concat('hdfs://nn1:8020/lake/raw/', lang, '/', source, '/doc_', CAST(doc_id AS VARCHAR), '.txt') AS uri,
         n_chars AS len, 'file' AS file_type FROM documents
  UNION ALL SELECT DISTINCT concat('hdfs://nn1:8020/lake/raw/', lang, '/', source), CAST(0 AS BIGINT), 'directory' FROM documents
  UNION ALL SELECT DISTINCT concat('hdfs://nn1:8020/lake/raw/', lang), CAST(0 AS BIGINT), 'directory' FROM documents
  UNION ALL SELECT DISTINCT 'hdfs://nn1:8020/lake/raw', CAST(0 AS BIGINT), 'directory' FROM documents)"""
MAPPED = (
    SOURCE
    + """,
mapped AS (
  SELECT uri AS source, len, file_type,
         concat('hdfs://nn2:8020/backup', substr(uri, length('hdfs://nn1:8020/lake') + 1)) AS destination FROM src)"""
)
BOTH = (
    MAPPED
    + """,
dst AS (
  SELECT concat('hdfs://nn2:8020/backup/raw/', d.lang, '/', d.source, '/doc_', CAST(d.doc_id AS VARCHAR), '.txt') AS uri,
         d.n_chars + l.toxic AS len, CASE WHEN l.toxic = 1 AND l.quality = 0 THEN 'directory' ELSE 'file' END AS file_type
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL SELECT DISTINCT concat('hdfs://nn2:8020/backup/raw/', lang, '/', source), CAST(3 AS BIGINT), 'file' FROM documents WHERE source = 'src0'
  UNION ALL SELECT concat('hdfs://nn2:8020/backup/old/part_', CAST(doc_id AS VARCHAR)), CAST(7 AS BIGINT), 'file'
    FROM labels WHERE quality = 0
  UNION ALL SELECT DISTINCT concat('hdfs://nn2:8020/backup/raw/', lang), CAST(0 AS BIGINT), 'directory' FROM documents
  UNION ALL SELECT DISTINCT 'hdfs://nn2:8020/backup/raw', CAST(0 AS BIGINT), 'directory' FROM documents
  UNION ALL SELECT DISTINCT 'hdfs://nn2:8020/backup', CAST(0 AS BIGINT), 'directory' FROM documents)"""
)
# Every (entry, ancestor) pair: an ancestor is what is left of the entry at one of its slashes.
CHAIN = (
    MAPPED
    + """,
cut AS (
  SELECT source AS uri, string_split(substr(source, length('hdfs://nn1:8020/lake/') + 1), '/') AS names,
         unnest(range(CAST(1 AS BIGINT), CAST(len(string_split(substr(source, length('hdfs://nn1:8020/lake/') + 1), '/')) AS BIGINT))) AS n
  FROM mapped),
chain AS (
  SELECT uri, CAST(n - 1 AS INTEGER) AS position, array_to_string(names[1:n], '/') AS folder FROM cut)"""
)
EXPANDED = (
    CHAIN
    + """,
expanded AS (
  SELECT concat('hdfs://nn1:8020/lake/', folder) AS source, concat('hdfs://nn2:8020/backup/', folder) AS destination,
         'directory' AS file_type, CAST(0 AS BIGINT) AS len, position FROM chain
  UNION ALL
  SELECT m.source, m.destination, m.file_type, m.len,
         CAST(coalesce((SELECT count(*) FROM chain c WHERE c.uri = m.source), 0) AS INTEGER) FROM mapped m)"""
)
LINEITEM_INDEX = """
keyed AS (
  SELECT l_orderkey, l_partkey, l_linenumber AS partition,
         CAST(l_suppkey % 5 + l_linenumber % 3 AS INTEGER) AS batch FROM lineitem),
idx AS (SELECT partition, max(batch) AS max_batch FROM keyed GROUP BY partition),
offsets AS (
  SELECT partition, max_batch,
         CAST(coalesce(sum(max_batch + 1) OVER (ORDER BY partition ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER)
           AS first_task
  FROM idx)"""
BALANCED = (
    MAPPED
    + """,
files AS (SELECT source, destination, len FROM mapped WHERE file_type = 'file'),
share AS (SELECT CAST(ceil(sum(len) / 48.0) AS BIGINT) AS bytes,
                 greatest(8, CAST(ceil(count(*) / 100000.0) AS BIGINT)) AS buckets FROM files),
bucketed AS (
  SELECT f.*, CAST(CAST('0x' || substr(md5(destination), 1, 8) AS BIGINT) % buckets AS INTEGER) AS partition FROM files f, share),
cuts AS (
  SELECT b.*, floor(coalesce(sum(len) OVER (PARTITION BY partition ORDER BY destination
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / (SELECT bytes FROM share)) AS cut
  FROM bucketed b),
balanced AS (
  SELECT source, destination, len, partition,
         CAST(dense_rank() OVER (PARTITION BY partition ORDER BY cut) - 1 AS INTEGER) AS batch FROM cuts)"""
)
TREE = """
tree AS (
  SELECT concat('/', lang, '/', source, '/doc_', CAST(doc_id AS VARCHAR), '.txt') AS path,
         CAST(strlen(text) AS BIGINT) AS len, 'file' AS file_type, CAST(3 AS INTEGER) AS depth,
         concat(':/', lang, ':/', lang, '/', source) AS ancestors FROM documents
  UNION ALL SELECT DISTINCT concat('/', lang, '/', source), CAST(0 AS BIGINT), 'directory', CAST(2 AS INTEGER), concat(':/', lang) FROM documents
  UNION ALL SELECT DISTINCT concat('/', lang), CAST(0 AS BIGINT), 'directory', CAST(1 AS INTEGER), '' FROM documents
  UNION ALL SELECT DISTINCT '', CAST(0 AS BIGINT), 'directory', CAST(0 AS INTEGER), '' FROM documents)"""
COPIED = (
    TREE
    + """,
good AS (SELECT d.doc_id, d.lang, d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1),
older AS (
  SELECT concat('/', lang, '/', source, '/doc_', CAST(doc_id AS VARCHAR), '.txt') AS path FROM good
  UNION ALL SELECT DISTINCT concat('/', lang, '/', source) FROM good
  UNION ALL SELECT DISTINCT concat('/', lang) FROM good
  UNION ALL SELECT ''),
copied AS (
  SELECT concat('/raw', t.path) AS path, t.file_type,
         CASE WHEN t.file_type = 'file' THEN CASE WHEN o.path IS NULL THEN 'copied' ELSE 'replaced' END
              ELSE CASE WHEN o.path IS NULL THEN 'dir_created' ELSE 'dir_exists' END END AS outcome,
         CASE WHEN t.file_type = 'file' THEN t.len END AS bytes
  FROM tree t LEFT JOIN older o ON t.path = o.path)"""
)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

ORACLES: dict[str, str] = {
    "qualify_path": """
SELECT doc_id, concat(lang, '//', source, '/doc_', doc_id) AS path,
       concat('hdfs://nn1:8020/user/etl/', lang, '/', source, '/doc_', doc_id) AS uri FROM documents
UNION ALL
SELECT doc_id, concat('/lake/./', lang, '/../', lang, '/', source, '/doc_', doc_id, '/'),
       concat('hdfs://nn1:8020/lake/', lang, '/', source, '/doc_', doc_id) FROM documents
UNION ALL
SELECT doc_id, concat('hdfs://nn2:8020/', lang, '/', source, '/doc ', doc_id),
       concat('hdfs://nn2:8020/', lang, '/', source, '/doc ', doc_id) FROM documents
UNION ALL
SELECT doc_id, concat('hdfs:///', lang, '/', source, '/doc_', doc_id),
       concat('hdfs://nn1:8020/', lang, '/', source, '/doc_', doc_id) FROM documents
UNION ALL
SELECT doc_id, concat('s3a://', source, '/', lang, '//doc%20', doc_id, '//'),
       concat('s3a://', source, '/', lang, '/doc%20', doc_id) FROM documents
UNION ALL
SELECT doc_id, concat('file:/', lang, '/x/y/../../', source, '/doc:', doc_id),
       concat('file:///', lang, '/', source, '/doc:', doc_id) FROM documents""",
    "map_destination": f"WITH {MAPPED} SELECT source AS uri, len, file_type, destination FROM mapped",
    "uri_is_child": """
WITH p AS (SELECT page_id, url AS uri, regexp_extract(url, '^[a-z]+://[^/]+/[^/]+', 0) AS section FROM pages),
r AS (SELECT page_id,
       uri = section OR starts_with(uri, concat(section, '/')) AS in_section,
       starts_with(uri, concat(section, '/')) AS in_section_slash,
       FALSE AS section_in_slash,
       TRUE AS slash_in_section,
       uri = concat(section, 'x') OR starts_with(uri, concat(section, 'x/')) AS in_longer,
       starts_with(uri, concat(substr(section, 1, length(section) - 1), '/')) AS in_shorter,
       FALSE AS in_other_scheme,
       rtrim(uri, '/') = section AND NOT ends_with(uri, '/') AS section_in_page
FROM p)
SELECT page_id, pair, is_child FROM r UNPIVOT (is_child FOR pair IN (
  in_section, in_section_slash, section_in_slash, slash_in_section, in_longer, in_shorter, in_other_scheme, section_in_page))""",
    "classify_file_type": f"""
WITH {SOURCE} SELECT uri, file_type, file_type = 'directory' AS is_directory, file_type = 'file' AS is_file FROM src""",
    "ancestor_dependencies": f"""
WITH {CHAIN} SELECT uri, position, concat('hdfs://nn1:8020/lake/', folder) AS ancestor,
                    CAST(0 AS BIGINT) AS ancestor_len, 'directory' AS ancestor_type FROM chain""",
    "dependent_copies": f"""
WITH {CHAIN} SELECT uri, position, concat('hdfs://nn1:8020/lake/', folder) AS source,
                    concat('hdfs://nn2:8020/backup/', folder) AS destination FROM chain""",
    "exclude_paths": """
WITH marked AS (
  SELECT doc_id, concat('hdfs://nn1:8020/out/', lang, '/', source, '/', name, doc_id) AS uri
  FROM documents, (VALUES ('_temporary/0/task-'), ('_SUCCESS-'), ('_committed_'), ('_started_'), ('x_temporary/part-'),
                          ('_temporary_copy/part-'), ('part-')) AS names(name)
  UNION ALL SELECT doc_id, concat('hdfs://nn1:8020/out/', lang, '/', source, '/', doc_id, '/_temporary') FROM documents)
SELECT doc_id, uri FROM marked
WHERE NOT (regexp_full_match(uri, '.*/_temporary($|/.*)') OR regexp_full_match(uri, '.*/_committed.*')
        OR regexp_full_match(uri, '.*/_started.*') OR regexp_full_match(uri, '.*/_SUCCESS.*'))""",
    "compare_manifests": f"""
WITH {BOTH}
SELECT m.source, coalesce(m.destination, d.uri) AS destination, coalesce(m.file_type, d.file_type) AS file_type,
       m.len, d.len AS dest_len, d.file_type AS dest_type,
       CASE WHEN d.uri IS NULL THEN 'source_only' WHEN m.source IS NULL THEN 'destination_only' ELSE 'both' END AS status
FROM mapped m FULL OUTER JOIN dst d ON m.destination = d.uri""",
    "copy_plan": f"""
WITH {BOTH}
SELECT m.source, m.destination, m.len, m.file_type, d.len AS dest_len, d.file_type AS dest_type,
       CASE WHEN d.file_type <> m.file_type THEN 'conflict'
            WHEN m.file_type = 'directory' THEN CASE WHEN d.uri IS NULL THEN 'create' ELSE 'keep' END
            ELSE CASE WHEN d.uri IS NULL THEN 'copy' ELSE 'replace' END END AS action
FROM mapped m LEFT JOIN dst d ON m.destination = d.uri""",
    "expand_copies": f"WITH {EXPANDED} SELECT source, destination, file_type, len, position FROM expanded",
    "expand_folder_ids": f"WITH {EXPANDED} SELECT source, destination, file_type, len, position FROM expanded",
    "distinct_copies": f"WITH {EXPANDED} SELECT DISTINCT source, destination, file_type, len FROM expanded",
    "directories_of": f"WITH {MAPPED} SELECT source, destination FROM mapped WHERE file_type = 'directory'",
    "verify_lengths": f"""
WITH {BOTH}
SELECT m.destination, m.source, m.len, d.len AS dest_len, m.len = d.len AS same_length
FROM mapped m JOIN dst d ON m.destination = d.uri WHERE m.file_type = 'file' AND d.file_type = 'file'""",
    "manifest_summary": f"""
WITH {SOURCE}
SELECT file_type, count(*) AS entries, CAST(sum(len) AS BIGINT) AS bytes FROM src GROUP BY file_type""",
    "batch_index": f"WITH {LINEITEM_INDEX} SELECT partition, max_batch FROM idx",
    "batch_partition_offsets": f"WITH {LINEITEM_INDEX} SELECT partition, max_batch, first_task FROM offsets",
    "assign_batch_partition": f"""
WITH {LINEITEM_INDEX}
SELECT k.l_orderkey, k.partition, CAST(k.l_partkey AS INTEGER) AS batch,
       CAST(o.first_task + k.l_partkey % (o.max_batch + 1) AS INTEGER) AS task
FROM keyed k JOIN offsets o ON k.partition = o.partition""",
    "balance_by_bytes": f"WITH {BALANCED} SELECT source, destination, len, partition, batch FROM balanced",
    "route_batches": f"""
WITH {BALANCED},
idx AS (SELECT partition, max(batch) AS max_batch FROM balanced GROUP BY partition),
offsets AS (
  SELECT partition, coalesce(sum(max_batch + 1) OVER (ORDER BY partition
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_task FROM idx)
SELECT b.destination, b.len, CAST(o.first_task + b.batch AS INTEGER) AS task,
       CAST(o.first_task + b.batch AS INTEGER) AS landed
FROM balanced b JOIN offsets o ON b.partition = o.partition""",
    "list_tree": f"WITH {TREE} SELECT path, len, file_type, depth, ancestors FROM tree",
    "read_tree_source": f"""
WITH {TREE}
SELECT path, len, file_type, depth FROM tree
WHERE (file_type = 'directory' AND depth <= 2) OR (file_type = 'file' AND depth > 2 AND starts_with(path, '/e'))""",
    "copy_following_links": """
WITH doubled AS (SELECT doc_id, source, unnest([lang, concat('copy_', lang)]) AS top FROM documents),
files AS (SELECT concat('/raw/', top, '/', source, '/doc_', CAST(doc_id AS VARCHAR), '.txt') AS path FROM doubled)
SELECT path, 'file' AS file_type, 'copied' AS outcome FROM files
UNION ALL SELECT concat(path, '.link'), 'file', 'copied' FROM files
UNION ALL SELECT concat(path, '.none'), 'link', 'skipped' FROM files
UNION ALL SELECT DISTINCT concat('/raw/', top, '/', source, '/up'), 'link', 'skipped' FROM doubled
UNION ALL SELECT DISTINCT concat('/raw/', top, '/', source), 'directory', 'dir_created' FROM doubled
UNION ALL SELECT DISTINCT concat('/raw/', top), 'directory', 'dir_created' FROM doubled
UNION ALL SELECT DISTINCT '/raw', 'directory', 'dir_created' FROM doubled""",
    "copy_byte_names": "SELECT doc_id, text FROM documents",
    "list_flat_directory": "SELECT concat('doc_', CAST(doc_id AS VARCHAR)) AS name, CAST(strlen(text) AS BIGINT) AS len FROM documents",
    "source_manifest": f"""
WITH {TREE}
SELECT path, concat('hdfs://nn2:8020/backup/raw', path) AS destination, len, file_type,
       CASE WHEN path = '' THEN '' ELSE
         concat('hdfs://nn2:8020/backup/raw', replace(ancestors, ':/', ' hdfs://nn2:8020/backup/raw/')) END AS dependent_folders
FROM tree""",
    "destination_manifest": f"WITH {TREE} SELECT path, len, file_type FROM tree",
    "create_directories": """
WITH days AS (
  SELECT DISTINCT o_orderstatus AS s, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m,
                  strftime(o_orderdate, '%d') AS d FROM orders),
made AS (
  SELECT concat('/', s, '/', y, '/', m, '/', d) AS path FROM days
  UNION SELECT concat('/', s, '/', y, '/', m) FROM days
  UNION SELECT concat('/', s, '/', y) FROM days
  UNION SELECT concat('/', s) FROM days)
SELECT path, 'directory' AS file_type, 'dir_created' AS outcome FROM made
UNION ALL SELECT DISTINCT '', 'directory', 'dir_exists' FROM orders
UNION ALL SELECT DISTINCT concat('/none/', o_orderpriority), 'directory', 'failed' FROM orders
UNION ALL SELECT DISTINCT concat('/file ', o_orderpriority), 'directory', 'failed' FROM orders""",
    "delete_paths": """
WITH files AS (
  SELECT d.doc_id, l.doc_id AS labelled, d.lang, d.source,
         concat('/', d.lang, '/', d.source, '/doc_', CAST(d.doc_id AS VARCHAR), '.txt') AS path
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT path, 'deleted' AS outcome FROM files WHERE labelled IS NOT NULL AND source <> 'src0'
UNION ALL SELECT path, 'left' FROM files WHERE labelled IS NULL AND source <> 'src0'
UNION ALL SELECT DISTINCT concat('/', lang, '/src0'), 'deleted' FROM files WHERE source = 'src0'
UNION ALL SELECT concat(path, '.none'), 'absent' FROM files WHERE labelled IS NOT NULL AND source <> 'src0'""",
    "copy_long_names": """
SELECT doc_id, kind, text FROM documents, (VALUES ('whole'), ('ranges')) AS kinds(kind)""",
    "copy_over_leftovers": """
SELECT doc_id, kind, text FROM documents, (VALUES ('whole'), ('ranges')) AS kinds(kind)""",
    "copy_tree_excluding": """
SELECT doc_id, name, text FROM documents, (VALUES ('part-'), ('x_temporary-')) AS names(name)""",
    "copy_tree_with_links": f"""
WITH {TREE}
SELECT concat('/raw', path) AS path, file_type, CASE WHEN file_type = 'file' THEN 'copied' ELSE 'dir_created' END AS outcome FROM tree
UNION ALL SELECT concat('/raw', path, '.link'), 'link', 'skipped' FROM tree WHERE file_type = 'file'""",
    "execute_copy": """
SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 'failed' ELSE 'copied' END AS outcome,
       CASE WHEN l.quality = 0 THEN NULL ELSE CAST(strlen(text) AS BIGINT) END AS bytes,
       CASE WHEN l.quality = 0 THEN NULL ELSE d.text END AS text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "copy_failing_replacements": """
SELECT d.doc_id, CASE WHEN l.toxic = 1 OR l.quality = 0 THEN 'failed' ELSE 'replaced' END AS outcome,
       CASE WHEN l.toxic = 1 OR l.quality = 0 THEN concat('older ', d.text) ELSE d.text END AS text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "recover_copies": """
SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'finished' WHEN l.doc_id IS NULL THEN 'untouched' ELSE 'undone' END AS outcome,
       CASE WHEN l.toxic = 1 THEN CAST(strlen(d.text) AS BIGINT) END AS bytes,
       CASE WHEN l.toxic = 1 THEN d.text WHEN l.doc_id IS NOT NULL THEN concat('older ', d.text) END AS text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "continue_copy": """
SELECT d.doc_id, 'copied' AS outcome, CAST(strlen(d.text) AS BIGINT) AS bytes,
       CASE WHEN l.toxic = 1 OR l.quality = 0 THEN d.text ELSE translate(d.text, 'aeiou', 'AEIOU') END AS text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "copy_report": f"WITH {COPIED} SELECT path, file_type, outcome, bytes, CAST(NULL AS VARCHAR) AS error FROM copied",
    "report_summary": f"""
WITH {COPIED}
SELECT file_type, outcome, count(*) AS entries, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes
FROM copied GROUP BY file_type, outcome""",
    "copy_tree_in_ranges": "SELECT doc_id, text FROM documents",
    "copy_tree_readback": " UNION ALL ".join(
        f"SELECT '{each}' AS table_name, count(*) AS rows FROM {each}" for each in TABLES
    ),
} | {f"copy_tree_readback_{each}": f"SELECT * FROM {each}" for each in TABLES}
ORACLES["copy_tree_readback_embeddings"] = """
SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS position, CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings"""
ORACLES["compare_kept_manifests"] = ORACLES["compare_manifests"]
