"""DuckDB statements for the registered queries, over the same check inputs."""

from __future__ import annotations

from .fixtures import ALL_SNAPSHOTS, ORDER, oracle
from .queries import CHUNK

ORACLES: dict[str, str] = {}
NONE = "CAST(NULL AS VARCHAR)"


def _bucket(*columns: str) -> str:
    """Bucket of a row within its key, by which rows are numbered in parts."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)})), 1, 2) AS INTEGER)"


# --- diffs ----------------------------------------------------------------------

DIFF = {
    "sets_new": "SELECT * FROM db_dataset a WHERE NOT EXISTS (FROM dh_dataset b WHERE b.physical_nm = a.physical_nm)",
    "sets_deleted": "SELECT * FROM dh_dataset b WHERE NOT EXISTS (FROM db_dataset a WHERE a.physical_nm = b.physical_nm)",
    "sets_updated": """SELECT physical_nm, schema, id, f AS differing_definition,
        CASE WHEN f THEN y END AS dh_definition, CASE WHEN f THEN x END AS db_definition
      FROM (SELECT a.physical_nm, a.schema, b.id, a.definition AS x, b.definition AS y,
          coalesce(trim(a.definition) <> trim(b.definition), false) AS f
        FROM db_dataset a JOIN dh_dataset b USING (physical_nm))
      WHERE trim(coalesce(x, '')) <> trim(coalesce(y, '')) AND trim(coalesce(x, '')) <> ''""",
    "items_new": """SELECT a.*, s.schema FROM db_dataitem a LEFT JOIN db_dataset s ON s.physical_nm = a.dataset_id
      WHERE a.physical_nm NOT IN (SELECT physical_nm FROM dh_dataitem)""",
    "items_deleted": """SELECT b.*, s.schema FROM dh_dataitem b JOIN dh_dataset s ON s.physical_nm = b.dataset_id
      WHERE s.schema IS NOT NULL AND b.physical_nm NOT IN (SELECT physical_nm FROM db_dataitem)""",
    "items_new_scoped": """SELECT a.*, s.schema FROM db_dataitem a LEFT JOIN db_dataset s ON s.physical_nm = a.dataset_id
      WHERE NOT EXISTS (FROM dh_dataitem b WHERE b.dataset_id = a.dataset_id AND b.physical_nm = a.physical_nm)""",
    "items_deleted_scoped": """SELECT b.*, s.schema FROM dh_dataitem b JOIN dh_dataset s ON s.physical_nm = b.dataset_id
      WHERE s.schema IS NOT NULL
        AND NOT EXISTS (FROM db_dataitem a WHERE b.dataset_id = a.dataset_id AND b.physical_nm = a.physical_nm)""",
}


def _flag(name: str, column: str, shape: str = "{}") -> str:
    x, y = shape.format(f"a.{column}"), shape.format(f"b.{column}")
    f = f"coalesce({x} <> {y}, false)"
    return (f"{f} AS {name}_changed, CASE WHEN {f} THEN {x} END AS {name}_database, "
            f"CASE WHEN {f} THEN {y} END AS {name}_catalog")


DIFF["items_updated"] = f"""SELECT a.physical_nm, a.dataset_id, s.schema, a.logical_nm, a.type, a.description, a.is_pk,
    a.key_nm, a.nullable, a.example, a.default_val, b.description AS dh_description, b.id, b.id AS item_id, t.id AS set_id,
    {_flag('type', 'type', "ltrim({}, '_')")}, {_flag('pk', 'is_pk')}, {_flag('keyname', 'key_nm', 'trim({})')},
    {_flag('nullable', 'nullable')}, {_flag('example', 'example', 'trim({})')},
    {_flag('default', 'default_val', 'trim({})')}
  FROM db_dataitem a JOIN dh_dataitem b USING (dataset_id, physical_nm)
    JOIN db_dataset s ON s.physical_nm = a.dataset_id JOIN dh_dataset t ON t.physical_nm = a.dataset_id
  WHERE ltrim(a.type, '_') <> ltrim(b.type, '_') OR coalesce(a.is_pk, false) <> coalesce(b.is_pk, false)
    OR coalesce(a.key_nm, '') <> coalesce(b.key_nm, '') OR coalesce(a.nullable, true) <> coalesce(b.nullable, true)
    OR (coalesce(a.example, '') <> coalesce(b.example, '') AND coalesce(a.example, '') <> '')
    OR coalesce(a.default_val, '') <> coalesce(b.default_val, '')"""


def _filled(*cols: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN trim({c}) <> '' THEN {c} END" for c in cols) + ")"


def _fold(c: str) -> str:
    return f"lower(trim(coalesce({c}, '')))"


_RULES = {"update": "on_update", "delete": "on_delete", "match": "on_match"}
DIFF["relationships_new"] = """SELECT a.*, s.schema FROM db_relationship a LEFT JOIN db_dataset s ON s.physical_nm = a.dataset_id
  WHERE a.physical_nm NOT IN (SELECT physical_nm FROM dh_relationship)"""
DIFF["relationships_deleted"] = """SELECT b.*, s.schema FROM dh_relationship b LEFT JOIN db_dataset s ON s.physical_nm = b.dataset_id
  WHERE b.physical_nm NOT IN (SELECT physical_nm FROM db_relationship)"""
DIFF["relationships_updated"] = f"""SELECT a.physical_nm, a.dataset_id, s.schema, {_filled('b.comment', 'a.comment')} AS comment,
    {_fold('b.comment')} AS dh_comment, {_fold('a.comment')} AS db_comment,
    {', '.join(f'{_filled(f"a.{c}", f"b.{c}")} AS {c}, {_fold(f"b.{c}")} AS dh_{k}, {_fold(f"a.{c}")} AS db_{k}, '
               f'{_fold(f"a.{c}")} <> {_fold(f"b.{c}")} AS {k}_changed' for k, c in _RULES.items())},
    {_filled('a.logical_nm', 'a.physical_nm')} AS logical_nm, b.id
  FROM db_relationship a JOIN dh_relationship b USING (physical_nm) LEFT JOIN db_dataset s ON s.physical_nm = b.dataset_id
  WHERE {' OR '.join(f'{_fold(f"a.{c}")} <> {_fold(f"b.{c}")}' for c in _RULES.values())}"""
DIFF["joins_new"] = """SELECT a.* FROM db_join a
  WHERE a.db_relationship_id NOT IN (SELECT physical_nm FROM dh_relationship)
    AND NOT EXISTS (FROM dh_join b WHERE b.parent_fqdn = a.parent_fqdn AND b.child_fqdn = a.child_fqdn)"""
DIFF["joins_deleted"] = """SELECT b.* FROM dh_join b
  WHERE b.db_relationship_id NOT IN (SELECT physical_nm FROM db_relationship)
    AND NOT EXISTS (FROM db_join a WHERE b.parent_fqdn = a.parent_fqdn AND b.child_fqdn = a.child_fqdn)"""
DIFF["joins_updated"] = """SELECT db_relationship_id, parent_fqdn, child_fqdn,
    coalesce(nullif(b.position, 0), nullif(a.position, 0), 0) AS position,
    coalesce(CASE WHEN trim(a.cardinality) <> '' THEN a.cardinality END,
      CASE WHEN trim(b.cardinality) <> '' THEN b.cardinality END, '1,1,0,-1') AS cardinality, r.id AS relationship_id
  FROM db_join a JOIN dh_join b USING (db_relationship_id, parent_fqdn, child_fqdn)
    JOIN dh_relationship r ON r.physical_nm = db_relationship_id
  WHERE a.position <> b.position OR a.cardinality <> b.cardinality"""


def _tables(sql: str) -> list[str]:
    return [n for n in ALL_SNAPSHOTS if f" {n} " in f" {sql.replace(')', ' ').replace(chr(10), ' ')} "]


for _name, _sql in DIFF.items():
    ORACLES[_name] = oracle(_sql, *_tables(_sql))

# --- cascades --------------------------------------------------------------------

_KEY_TYPE = "CASE WHEN {0}is_pk THEN 'primary' WHEN {0}key_nm <> '' THEN 'foreign' END"
_KEY_NAME = "CASE WHEN trim({0}) <> '' THEN {0} END"
CASCADE = {
    **DIFF,
    "set_chg": f"""SELECT 'add' AS change_type, lower(physical_nm) AS entity_id, physical_nm, logical_nm, schema, description,
        CASE WHEN trim(type) <> '' THEN type END AS type, definition, {NONE} AS catalog_id,
        concat(schema, '.', physical_nm) AS fqdn FROM sets_new
      UNION ALL SELECT 'delete', lower(physical_nm), physical_nm, logical_nm, schema, description, NULL, NULL, id,
        concat(schema, '.', physical_nm) FROM sets_deleted
      UNION ALL SELECT 'update', lower(physical_nm), physical_nm, NULL, schema, NULL, NULL, db_definition, id,
        concat(schema, '.', physical_nm) FROM sets_updated""",
    "item_chg": f"""SELECT 'add' AS change_type, dataset_id, physical_nm, schema, logical_nm, type, description,
        {_KEY_TYPE.format('')} AS key_type, {_KEY_NAME.format('key_nm')} AS key_name, nullable, example, default_val,
        {NONE} AS set_id, {NONE} AS item_id, metadata FROM items_new_scoped
      UNION ALL SELECT 'delete', dataset_id, physical_nm, schema, logical_nm, type, description, {_KEY_TYPE.format('')},
        {_KEY_NAME.format('key_nm')}, nullable, example, default_val, NULL, id, metadata FROM items_deleted_scoped
        WHERE lower(dataset_id) NOT IN (SELECT lower(physical_nm) FROM sets_deleted)
      UNION ALL SELECT 'update', dataset_id, physical_nm, schema, logical_nm,
        CASE WHEN type_changed THEN type_database ELSE type END,
        CASE WHEN dh_description <> '' THEN dh_description ELSE description END,
        CASE WHEN pk_changed AND NOT pk_database THEN 'foreign' ELSE {_KEY_TYPE.format('')} END,
        {_KEY_NAME.format('(CASE WHEN keyname_changed THEN keyname_database ELSE key_nm END)')},
        CASE WHEN nullable_changed THEN nullable_database ELSE nullable END,
        CASE WHEN example_changed THEN example_database ELSE example END,
        CASE WHEN default_changed THEN default_database ELSE default_val END, set_id, item_id, NULL FROM items_updated""",
    "set_owner": """SELECT coalesce(a.physical_nm, b.physical_nm) AS nm, coalesce(a.schema, b.schema) AS schema
      FROM db_dataset a FULL JOIN dh_dataset b USING (physical_nm)""",
    "rel_all": f"""SELECT 'add' AS change_type, physical_nm, dataset_id, logical_nm, comment, on_update, on_delete, on_match, type,
        {NONE} AS catalog_id FROM relationships_new
      UNION ALL SELECT 'delete', physical_nm, dataset_id, logical_nm, comment, on_update, on_delete, on_match, type, id
        FROM relationships_deleted
      UNION ALL SELECT 'update', physical_nm, dataset_id, logical_nm, comment, on_update, on_delete, on_match, NULL, id
        FROM relationships_updated""",
    "rel_chg": """SELECT r.*, o.schema FROM rel_all r JOIN set_owner o ON o.nm = r.dataset_id
      WHERE r.dataset_id NOT IN (SELECT physical_nm FROM sets_deleted)""",
    "rel_gone": "SELECT physical_nm FROM rel_chg WHERE change_type = 'delete'",
    "join_kept": f"""SELECT 'add' AS change_type, j.*, {NONE} AS relationship_id, CAST(NULL AS BOOLEAN) AS creates_relationship
        FROM joins_new j JOIN db_relationship r ON r.physical_nm = j.db_relationship_id
        WHERE r.dataset_id NOT IN (SELECT physical_nm FROM sets_deleted)
      UNION ALL SELECT 'delete', j.*, NULL, NULL FROM joins_deleted j JOIN dh_relationship r ON r.physical_nm = j.db_relationship_id
        WHERE r.dataset_id NOT IN (SELECT physical_nm FROM sets_deleted)
      UNION ALL SELECT 'update', j.* EXCLUDE (relationship_id), relationship_id,
        j.db_relationship_id NOT IN (SELECT physical_nm FROM db_relationship) FROM joins_updated j""",
    "join_chg": """SELECT change_type, db_relationship_id, relationship_id, creates_relationship,
        split_part(parent_fqdn, '.', 1) AS parent_schema, split_part(parent_fqdn, '.', 2) AS parent_set,
        split_part(parent_fqdn, '.', 3) AS parent_item, split_part(child_fqdn, '.', 1) AS child_schema,
        split_part(child_fqdn, '.', 2) AS child_set, split_part(child_fqdn, '.', 3) AS child_item, parent_fqdn, child_fqdn,
        coalesce(position, 0) AS position, CASE WHEN trim(cardinality) <> '' THEN cardinality ELSE '1,1,0,-1' END AS cardinality
      FROM join_kept WHERE db_relationship_id NOT IN (FROM rel_gone)""",
    "feed": """SELECT 'set' AS entity, change_type, entity_id, catalog_id, schema, physical_nm AS set_nm, physical_nm AS name
        FROM set_chg
      UNION ALL SELECT 'item', change_type, lower(trim(concat(schema, '.', dataset_id, '.', physical_nm))), item_id, schema,
        dataset_id, physical_nm FROM item_chg
      UNION ALL SELECT 'relationship', change_type, lower(physical_nm), catalog_id, schema, dataset_id, physical_nm FROM rel_chg
      UNION ALL SELECT 'join', change_type, lower(parent_fqdn) || '::' || lower(child_fqdn), relationship_id, parent_schema,
        parent_set, parent_fqdn || ' -> ' || child_fqdn FROM join_chg""",
}


def cascaded(body: str, **extra: str) -> str:
    return oracle(body, *ALL_SNAPSHOTS, extra={**CASCADE, **extra})


ORACLES["set_delta_cascade"] = cascaded("FROM set_chg")
ORACLES["item_delta_cascade"] = cascaded("FROM item_chg")
ORACLES["relationship_delta_cascade"] = cascaded("FROM rel_chg")
ORACLES["join_delta_cascade"] = cascaded("FROM join_chg")
ORACLES["unresolved_relationships"] = cascaded(
    "SELECT change_type, physical_nm, dataset_id FROM rel_all WHERE dataset_id NOT IN (SELECT nm FROM set_owner)")
ORACLES["change_feed"] = cascaded("FROM feed")
def _text(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)


ORACLES["change_feed_bodies"] = cascaded(f"""SELECT 'set' AS entity, change_type, entity_id, physical_nm AS name,
      {_text("logical_nm", "description", "type", "definition", "fqdn")} AS body FROM set_chg
    UNION ALL SELECT 'item', change_type, lower(trim(concat(schema, '.', dataset_id, '.', physical_nm))), physical_nm,
      {_text("logical_nm", "type", "description", "key_type", "key_name", "nullable", "example", "default_val", "set_id", "item_id", "metadata")} FROM item_chg
    UNION ALL SELECT 'relationship', change_type, lower(physical_nm), physical_nm,
      {_text("logical_nm", "comment", "on_update", "on_delete", "on_match", "type", "catalog_id")} FROM rel_chg
    UNION ALL SELECT 'join', change_type, lower(parent_fqdn) || '::' || lower(child_fqdn), parent_fqdn || ' -> ' || child_fqdn,
      {_text("db_relationship_id", "relationship_id", "creates_relationship", "parent_item", "child_schema", "child_item", "position", "cardinality")} FROM join_chg""")
ORACLES["addition_membership"] = cascaded("""SELECT lower(physical_nm) AS entity_id,
    lower(physical_nm) IN (SELECT entity_id FROM set_chg WHERE change_type = 'add') AS has_add FROM wdb""",
    wdb="SELECT concat('ds_', p_partkey) AS physical_nm FROM part")
ORACLES["diff_membership"] = cascaded("""SELECT lower(physical_nm) AS entity_id,
    lower(physical_nm) IN (SELECT entity_id FROM set_chg WHERE change_type = 'delete') AS has_delete,
    lower(physical_nm) IN (SELECT entity_id FROM set_chg WHERE change_type = 'update') AS has_update FROM dh_dataset""")
ORACLES["delta_counts"] = cascaded("SELECT entity, change_type, count(*) AS n FROM feed GROUP BY ALL")
ORACLES["delta_preview"] = cascaded("""SELECT entity, change_type, seq, CASE WHEN seq = 36 THEN m || ' and more...' ELSE line END AS line
  FROM (SELECT *, row_number() OVER (PARTITION BY entity, change_type ORDER BY label, line) AS seq FROM lines)
  WHERE seq <= 36""", lines="""SELECT entity, change_type, label, m, m || ' ' || label ||
    CASE WHEN entity <> 'join' AND change_type <> 'add' THEN ' (' || coalesce(catalog_id, '') || ')' ELSE '' END AS line
    FROM (SELECT *, CASE change_type WHEN 'add' THEN '+' WHEN 'delete' THEN '-' ELSE '!' END AS m,
      CASE WHEN entity = 'item' THEN set_nm || '.' || name ELSE name END AS label FROM feed)""")
ORACLES["diff_json"] = cascaded(f"""SELECT entity, part, count(*) FILTER (change_type = 'add') AS n_add,
    count(*) FILTER (change_type = 'delete') AS n_delete, count(*) FILTER (change_type = 'update') AS n_update,
    string_agg(change_type || ':' || entity_id || ':' || name, ';' ORDER BY change_type || ':' || entity_id || ':' || name) AS entries
  FROM (SELECT *, (row_number() OVER (PARTITION BY entity ORDER BY {_bucket('change_type', 'entity_id', 'catalog_id', 'name')},
      change_type, entity_id, catalog_id NULLS FIRST, name) - 1) // {CHUNK} AS part FROM feed)
  GROUP BY entity, part""")

# --- payloads --------------------------------------------------------------------------

ORACLES["payload_sets"] = cascaded("""SELECT change_type, catalog_id, physical_nm AS physical, nullif(logical_nm, '') AS logical,
    nullif(description, '') AS description, CASE WHEN trim(definition) <> '' THEN definition END AS view_source FROM set_chg""")
ORACLES["payload_items"] = cascaded("""SELECT change_type, dataset_id, physical_nm AS physical, nullif(logical_nm, '') AS logical,
    nullable, nullif(description, '') AS description, nullif(type, '') AS udt_type, nullif(default_val, '') AS default_val,
    key_name, CASE WHEN key_name IS NOT NULL THEN coalesce(key_type, '') = 'primary' END AS key_primary,
    CASE WHEN metadata IS NOT NULL THEN
      CASE WHEN trunc(CAST(json_extract_string(metadata, '$.null_percentage') AS DOUBLE)) = 0 THEN '0'
        ELSE printf('%.2f', CAST(json_extract_string(metadata, '$.null_percentage') AS DOUBLE)) END END AS null_percentage,
    nullif(example, '') AS example FROM item_chg""")
ORACLES["payload_metadata"] = cascaded("""SELECT 'item' AS entity, change_type, dataset_id || '.' || physical_nm AS key,
      CASE WHEN m THEN coalesce(example, '') END AS most_common, CASE WHEN m THEN length(physical_nm) || '.25' END AS null_share,
      CASE WHEN m THEN CAST(length(dataset_id) AS VARCHAR) END AS n, NULL AS view_source, CASE WHEN m THEN 1 END AS kept
    FROM (SELECT *, physical_nm LIKE '%\\_1' ESCAPE '\\' AS m FROM item_chg)
  UNION ALL SELECT 'set', change_type, physical_nm, 'm', NULL, CAST(length(physical_nm) AS VARCHAR),
      CASE WHEN trim(definition) <> '' THEN definition ELSE 'old' END, 2 FROM set_chg""")
_PAIRS = """SELECT db_relationship_id, parent_fqdn, child_fqdn, position, cardinality,
    row_number() OVER (PARTITION BY db_relationship_id ORDER BY position, parent_fqdn, child_fqdn) AS rn,
    row_number() OVER (PARTITION BY db_relationship_id ORDER BY """ + _bucket('position', 'parent_fqdn', 'child_fqdn') + """, position, parent_fqdn, child_fqdn) AS bn FROM db_join"""
ORACLES["payload_relationships"] = cascaded("""SELECT change_type, r.physical_nm, (p.bn - 1) // 3 AS part,
    split_part(f.parent_fqdn, '.', 1) || '.' || split_part(f.parent_fqdn, '.', 2) AS parent_set,
    split_part(f.child_fqdn, '.', 1) || '.' || split_part(f.child_fqdn, '.', 2) AS child_set,
    nullif(logical_nm, '') AS logical, CASE WHEN f.cardinality <> '' THEN f.cardinality ELSE '1,1,0,-1' END AS cardinality,
    upper(coalesce(on_update, '')) AS on_update, upper(coalesce(on_delete, '')) AS on_delete,
    upper(nullif(on_match, '')) AS match_type,
    string_agg(p.parent_fqdn || '>' || p.child_fqdn, ';' ORDER BY p.rn) AS items
  FROM rel_chg r JOIN pairs p ON p.db_relationship_id = r.physical_nm
    JOIN pairs f ON f.db_relationship_id = r.physical_nm AND f.rn = 1
  GROUP BY ALL""", pairs=_PAIRS)
ORACLES["payload_requests"] = cascaded(f"""SELECT CASE change_type WHEN 'delete' THEN 1 WHEN 'add' THEN 2 ELSE 3 END AS phase_no,
    change_type AS phase, entity, target_id, part, n FROM (
      SELECT change_type, 'set' AS entity, catalog_id AS target_id, 0 AS part, CAST(NULL AS INT) AS n FROM set_chg
      UNION ALL SELECT change_type, 'item', item_id, 0, NULL FROM item_chg WHERE change_type = 'delete'
      UNION ALL SELECT change_type, 'item', sid, part, count(*) FROM numbered GROUP BY change_type, sid, part
      UNION ALL SELECT change_type, 'relationship', NULL, (rn - 1) // {CHUNK}, count(*) FROM rel_numbered GROUP BY 1, 4)""",
    numbered=f"""SELECT change_type, sid, (row_number() OVER (PARTITION BY change_type, sid ORDER BY physical_nm, dataset_id) - 1)
        // {CHUNK} AS part FROM (SELECT i.*, coalesce(i.set_id, d.id) AS sid FROM item_chg i
        LEFT JOIN dh_dataset d ON d.physical_nm = i.dataset_id) WHERE change_type <> 'delete' AND sid IS NOT NULL""",
    pairs=_PAIRS,
    rel_numbered=f"""SELECT change_type, row_number() OVER (PARTITION BY change_type ORDER BY k, n) AS rn FROM (
        SELECT change_type, catalog_id AS k, 0 AS n FROM rel_chg WHERE change_type = 'delete'
        UNION ALL SELECT DISTINCT change_type, physical_nm, (rn - 1) // {CHUNK} FROM rel_chg
          JOIN pairs ON db_relationship_id = physical_nm WHERE change_type <> 'delete')""")

_N = "CAST(regexp_extract({}, '([0-9]+)$', 1) AS BIGINT)"
ORACLES["requests_after_replies"] = cascaded(f"""SELECT change_type AS phase, entity, coalesce(target, CASE WHEN took THEN 'NEW' || n_set END) AS target_id,
    target_name, part, n, entity = 'set' AND change_type = 'add' OR target IS NOT NULL OR coalesce(took, false) AS ready
  FROM (SELECT *, {_N.format('target_name')} AS n_set, n_set % 4 <> 0 AND n_set % 3 <> 1 AS took FROM all_requests)
  WHERE NOT (entity = 'set' AND change_type = 'add' AND took)""",
    sent="""SELECT i.*, coalesce(i.set_id, d.id) AS sid, CASE WHEN coalesce(i.set_id, d.id) IS NULL AND s.physical_nm IS NOT NULL
        THEN concat(i.schema, '.', i.dataset_id) END AS new_set
      FROM item_chg i LEFT JOIN dh_dataset d ON d.physical_nm = i.dataset_id
        LEFT JOIN (FROM set_chg WHERE change_type = 'add') s ON s.schema = i.schema AND s.physical_nm = i.dataset_id""",
    all_requests=f"""SELECT change_type, 'set' AS entity, catalog_id AS target, CASE change_type WHEN 'add' THEN fqdn END AS target_name, 0 AS part,
        CAST(NULL AS INT) AS n FROM set_chg
      UNION ALL SELECT change_type, 'item', item_id, NULL, 0, NULL FROM item_chg WHERE change_type = 'delete'
      UNION ALL SELECT change_type, 'item', sid, new_set, part, count(*) FROM (
        SELECT *, (row_number() OVER (PARTITION BY change_type, sid, new_set ORDER BY physical_nm, dataset_id) - 1) // {CHUNK} AS part FROM sent
        WHERE change_type <> 'delete' AND (sid IS NOT NULL OR new_set IS NOT NULL)) GROUP BY ALL""")
ORACLES["unresolved_items"] = cascaded(f"""SELECT *, false AS in_source, false AS in_catalog FROM (
    SELECT 'add' AS change_type, dataset_id, physical_nm, {NONE} AS item_id FROM items_new_scoped
    UNION ALL SELECT 'delete', dataset_id, physical_nm, id FROM items_deleted_scoped
    UNION ALL SELECT 'update', dataset_id, physical_nm, item_id FROM items_updated) WHERE {_N.format('dataset_id')} % 7 = 0""")

# --- snapshots -----------------------------------------------------------------------------

_KEYS = {"dataset": "physical_nm", "dataitem": "dataset_id, physical_nm", "relationship": "physical_nm",
         "join": "db_relationship_id, parent_fqdn, child_fqdn"}
for _q, _t in {"upsert_sets": "dataset", "upsert_items": "dataitem", "upsert_relationships": "relationship",
               "upsert_joins": "join"}.items():
    _cols = "* EXCLUDE (id)" if _t != "join" else "*"
    ORACLES[_q] = oracle(f"""SELECT {_cols} FROM dh_{_t} UNION ALL BY NAME
        SELECT * FROM db_{_t} WHERE ({_KEYS[_t]}) NOT IN (SELECT ({_KEYS[_t]}) FROM dh_{_t})""", f"db_{_t}", f"dh_{_t}")
ORACLES["versioned_upsert_items"] = ORACLES["upsert_items"]
ORACLES["item_cascade_from_versions"] = ORACLES["item_delta_cascade"]
ORACLES["snapshot_sql"] = oracle("""SELECT s.schema, s.type, count(*) AS n_items, count(*) FILTER (c.is_pk) AS n_keys
  FROM wdb_dataitem c JOIN wdb_dataset s ON s.physical_nm = c.dataset_id GROUP BY s.schema, s.type""", "wdb_dataitem", "wdb_dataset")

# --- lookups ---------------------------------------------------------------------------------

ORACLES["set_lookup"] = oracle("""SELECT physical_nm, schema, id FROM wdh_dataset
  WHERE lower(trim(physical_nm)) IN (SELECT 'ds_' || s_suppkey FROM supplier)""", "wdh_dataset")
ORACLES["set_id_resolution"] = oracle("""SELECT schema, dataset_id, physical_nm, coalesce(own, a, b, c) AS set_id,
    CASE WHEN own IS NOT NULL THEN 'own' WHEN a IS NOT NULL THEN 'schema' WHEN b IS NOT NULL THEN 'snapshot'
      WHEN c IS NOT NULL THEN 'remote' END AS resolved_by
  FROM (SELECT i.schema, i.dataset_id, i.physical_nm,
      CASE WHEN i.physical_nm LIKE '%\\_2' ESCAPE '\\' THEN 'OWN' || i.dataset_id END AS own,
      CASE WHEN s.schema = i.schema AND s.schema <> 'sch_0' THEN s.id END AS a, s.id AS b,
      CASE WHEN p_partkey % 2 = 0 THEN 'REM' || p_partkey END AS c
    FROM items_new_scoped i LEFT JOIN dh_dataset s ON s.physical_nm = i.dataset_id
      LEFT JOIN part ON 'ds_' || p_partkey = i.dataset_id)""", *ALL_SNAPSHOTS, extra=DIFF)
ORACLES["endpoint_resolution"] = oracle("""SELECT db_relationship_id, parent_fqdn, child_fqdn,
    pf IN (SELECT f FROM sets) AS parent_set_found, pf IN (SELECT f FROM sets) AND pi IN (SELECT f FROM its) AS parent_item_found,
    cf IN (SELECT f FROM sets) AS child_set_found, cf IN (SELECT f FROM sets) AND ci IN (SELECT f FROM its) AS child_item_found
  FROM (SELECT *, split_part(parent_fqdn, '.', 1) || '.' || split_part(parent_fqdn, '.', 2) AS pf,
      split_part(parent_fqdn, '.', 2) || '.' || split_part(parent_fqdn, '.', 3) AS pi,
      split_part(child_fqdn, '.', 1) || '.' || split_part(child_fqdn, '.', 2) AS cf,
      split_part(child_fqdn, '.', 2) || '.' || split_part(child_fqdn, '.', 3) AS ci FROM wdb_join)""",
    "wdb_join", "wdb_dataset", extra={
        "sets": "SELECT schema || '.' || physical_nm AS f FROM wdb_dataset",
        "its": "SELECT DISTINCT concat('ds_', l_partkey, '.c_', l_linenumber) AS f FROM lineitem"})
ORACLES["outdated_relationships"] = oracle("""SELECT 'delete' AS phase, physical_nm, id FROM dh_relationship
    WHERE physical_nm NOT IN (SELECT physical_nm FROM db_relationship)
  UNION ALL SELECT 'upsert', physical_nm, NULL FROM db_relationship""", "db_relationship", "dh_relationship")

# --- catalog documents (expected rows straight from the base tables) -----------------------------

_TWO = "(SELECT unnest(['', 'b']) AS v)"
ORACLES["catalog_sets"] = f"""SELECT concat('sch_', p_size % 5) AS schema, p_type AS schema_comment, concat('S', p_partkey, v) AS id,
    concat('ds_', p_partkey, v) AS physical_nm, p_name AS logical_nm, p_brand AS description,
    concat('sch_', p_size % 5, '.ds_', p_partkey, v) AS fqdn,
    CASE WHEN p_partkey % 3 = 0 THEN concat('V ', p_partkey) WHEN p_partkey % 4 = 0 THEN 'SELECT 1' ELSE '' END AS definition,
    CASE WHEN p_partkey % 3 = 0 THEN concat('{{"view_source":"V ', p_partkey, '","x":1}}') WHEN p_partkey % 5 = 0 THEN '{{"x":2}}' END AS metadata
  FROM part, {_TWO} WHERE p_partkey % 101 <> 0"""
_ITEM_DOC = f"""SELECT concat('ds_', l_partkey) AS dataset_id, concat('I', l_orderkey, '_', l_linenumber, v) AS id,
    concat('c_', l_orderkey, '_', l_linenumber, v) AS physical_nm, concat('C ', l_orderkey) AS logical_nm,
    l_linestatus AS description, 'text' AS type, l_linenumber <> 1 AS nullable,
    concat('s.ds_', l_partkey, '.c_', l_orderkey, '_', l_linenumber, v) AS fqdn,
    CASE WHEN l_suppkey % 5 = 0 THEN 'now' END AS default_val, CASE WHEN l_suppkey % 3 = 0 THEN 'e' END AS example,
    CASE WHEN l_suppkey % 2 = 0 THEN concat('{{"n":', l_linenumber, '}}') END AS metadata,
    CASE l_linenumber WHEN 1 THEN concat('pk_', l_partkey, ':primary:', nm) WHEN 2 THEN
      concat('fk_', l_orderkey, ':foreign:', nm, ',pk_', l_partkey, ':primary:', nm) ELSE '' END AS keys,
    l_partkey, l_linenumber
  FROM (SELECT *, concat('c_', l_orderkey, '_', l_linenumber, v) AS nm FROM lineitem, {_TWO} WHERE l_orderkey % 101 <> 0)"""
ORACLES["catalog_items"] = f"SELECT * EXCLUDE (l_partkey, l_linenumber) FROM ({_ITEM_DOC})"
ORACLES["stash_items"] = f"""SELECT dataset_id, physical_nm, logical_nm, type, description, l_linenumber <= 2 AS is_pk,
    CASE WHEN l_linenumber <= 2 THEN concat('pk_', l_partkey) ELSE '' END AS key_nm, nullable, coalesce(example, '') AS example,
    coalesce(default_val, '') AS default_val, metadata, id FROM ({_ITEM_DOC})"""
_REL_DOC = """SELECT concat('R', o_orderkey) AS id, concat('fk_', o_orderkey) AS physical_nm, concat('FK ', o_orderkey) AS logical_nm,
    concat('ds_', o_custkey) AS dataset_id, o_orderpriority AS comment, 'cascade' AS on_update, o_orderstatus AS on_delete,
    'none' AS on_match, 'sch_0' AS parent_schema, concat('ds_', o_custkey) AS parent_set, 'c_' || n AS parent_item,
    concat('sch_0.ds_', o_custkey, '.c_', n) AS parent_fqdn, 'sch_1' AS child_schema, concat('ds_', o_orderkey) AS child_set,
    'c_' || n AS child_item, concat('sch_1.ds_', o_orderkey, '.c_', n) AS child_fqdn, n AS position,
    concat('1,1,', o_custkey % 3, ',-1') AS cardinality
  FROM orders, (SELECT unnest([1, 2]) AS n) WHERE o_orderkey % 101 <> 0 AND o_orderkey % 19 <> 0"""
ORACLES["catalog_relationships"] = _REL_DOC
ORACLES["stash_relationships"] = f"""SELECT DISTINCT physical_nm, dataset_id, logical_nm, '' AS type, comment, on_update, on_delete,
    on_match, id FROM ({_REL_DOC})"""
ORACLES["stash_joins"] = f"""SELECT physical_nm AS db_relationship_id, parent_fqdn, child_fqdn, position, cardinality
  FROM ({_REL_DOC})"""
ORACLES["malformed_documents"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN '{"relationships":[' ELSE '[1]' END AS doc
  FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0"""

# --- database catalog ---------------------------------------------------------------------------

ORACLES["schema_filter"] = oracle("""SELECT *, 'patterns' AS rule FROM tables WHERE table_schema LIKE 'sch_1' OR table_schema LIKE '%h_3'
  UNION ALL SELECT *, 'default' FROM tables WHERE table_schema NOT IN ('pg_catalog', 'information_schema')""", "tables")
_CATALOG = ["tables", "columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description", "key_column_usage",
            "table_constraints", "views"]
_NAMED = {
    "cls": "SELECT k.oid, k.relname, k.relkind, n.nspname FROM pg_class k JOIN pg_namespace n ON n.oid = k.relnamespace",
    "about": "SELECT objoid, description AS txt FROM description WHERE objsubid = 0",
    "idx": """SELECT nspname, relname, attname, indisprimary FROM (
        SELECT indrelid, indisprimary, unnest(list_distinct(indkey)) AS no FROM pg_index) x
      JOIN pg_attribute ON attrelid = indrelid AND attnum = no JOIN cls ON cls.oid = indrelid""",
    "ent_txt": "SELECT nspname, relname, txt FROM cls LEFT JOIN about ON objoid = oid",
    "col_txt": """SELECT nspname, relname, objsubid, description AS txt FROM cls JOIN description ON objoid = oid
      WHERE relkind IN ('r', 't', 'm')""",
    "key_use": """SELECT u.constraint_schema AS us, u.table_name AS ut, u.column_name AS uc, u.ordinal_position AS up,
        c.constraint_name AS cn, lower(c.constraint_type) AS ct FROM key_column_usage u
      LEFT JOIN table_constraints c USING (constraint_schema, constraint_name)""",
    "sch_txt": "SELECT nspname, txt FROM pg_namespace JOIN about ON objoid = oid",
}
_FACTS = """coalesce(c.is_nullable = 'YES', false) AS nullable, c.column_default AS "default",
    c.character_maximum_length AS max_length, c.numeric_precision, c.numeric_precision_radix, c.numeric_scale,
    coalesce(c.identity_cycle = 'YES', false) AS identity_cycle, CAST(c.identity_increment AS BIGINT) AS identity_increment,
    lower(c.identity_generation) AS identity_generation, CAST(c.identity_start AS BIGINT) AS identity_start,
    coalesce(c.is_identity = 'YES', false) AS identity, CAST(c.identity_minimum AS BIGINT) AS identity_minimum,
    CAST(c.identity_maximum AS BIGINT) AS identity_maximum, c.udt_name AS udt_type,
    CAST(c.datetime_precision AS BIGINT) AS datetime_precision, c.interval_type,
    CAST(c.interval_precision AS BIGINT) AS interval_precision"""


def _entities(strict: bool) -> str:
    return f"""SELECT c.table_schema AS schema, h.txt AS schema_comment, c.table_name AS entity,
        concat(c.table_schema, '.', c.table_name) AS entity_fqdn, c.column_name AS name,
        concat(c.table_schema, '.', c.table_name, '.', c.column_name) AS fqdn, c.ordinal_position AS position,
        c.data_type AS type, {_FACTS}, lower(t.table_type) AS entity_type, t.table_type = 'VIEW' AS "view",
        coalesce(i.indisprimary, false) AS primary_key, e.txt AS entity_comment, d.txt AS comment, uc IS NOT NULL AS "key",
        up AS key_position, ct AS key_type, cn AS key_name,
        CASE WHEN t.table_type = 'VIEW' THEN trim(v.definition) END AS definition
      FROM tables t LEFT JOIN columns c USING (table_schema, table_name)
        LEFT JOIN idx i ON i.relname = c.table_name AND i.attname = c.column_name AND i.nspname = c.table_schema
        LEFT JOIN ent_txt e ON e.relname = c.table_name {'AND e.nspname = c.table_schema' if strict else ''}
        LEFT JOIN col_txt d ON d.nspname = c.table_schema AND d.relname = c.table_name AND d.objsubid = c.ordinal_position
        LEFT JOIN key_use ON uc = c.column_name AND us = c.table_schema {'AND ut = c.table_name' if strict else ''}
        LEFT JOIN sch_txt h ON h.nspname = c.table_schema
        LEFT JOIN views v ON v.schemaname = c.table_schema AND v.viewname = c.table_name
      WHERE t.table_schema NOT IN ('pg_catalog', 'information_schema')"""


ORACLES["entities_flatten"] = oracle(_entities(False), *_CATALOG, extra=_NAMED)
ORACLES["entities_flatten_strict"] = oracle(_entities(True), *_CATALOG, extra=_NAMED)
_ORDER = '"schema", entity, "position", key_name, key_type'
ORACLES["entities_ordered"] = oracle(f"""SELECT row_number() OVER (ORDER BY {", ".join(c + " NULLS FIRST" for c in _ORDER.split(", "))}) AS seq,
    {_ORDER}, fqdn FROM ({_entities(True)})""", *_CATALOG, extra=_NAMED)
ORACLES["entity_sets"] = oracle("""SELECT schema, entity AS physical_nm, entity AS logical_nm, min(CASE WHEN "view" THEN 'VIEW'
      WHEN entity_type = 'base table' THEN 'TABLE' ELSE upper(entity_type) END) AS type,
    min(CASE WHEN trim(definition) <> '' THEN definition END) AS definition, min(schema_comment) AS schema_comment,
    min(entity_comment) AS description FROM ents GROUP BY schema, entity""", *_CATALOG, extra={**_NAMED, "ents": _entities(True)})
ORACLES["entity_items"] = oracle("""SELECT schema, entity AS dataset_id, name AS physical_nm, fqdn, coalesce(comment, '') AS description,
    coalesce(udt_type, '') AS type, identity, coalesce("default", 'NULL') AS default_val, nullable,
    CASE WHEN "key" THEN coalesce(key_name, '') END AS key_name,
    CASE WHEN "key" THEN CASE WHEN primary_key THEN 'primary' ELSE replace(coalesce(key_type, 'foreign'), ' key', '') END END AS key_type
  FROM ents""", *_CATALOG, extra={**_NAMED, "ents": _entities(True)})


def _matviews(strict: bool) -> str:
    return f"""SELECT m.schemaname AS schema, h.txt AS schema_comment, m.matviewname AS entity,
        concat(m.schemaname, '.', m.matviewname) AS entity_fqdn, a.attname AS name,
        concat(m.schemaname, '.', m.matviewname, '.', a.attname) AS fqdn, a.attnum AS position, a.atttype AS type, {_FACTS},
        'materialized view' AS entity_type, true AS "view", coalesce(i.indisprimary, false) AS primary_key,
        e.txt AS entity_comment, d.txt AS comment, uc IS NOT NULL AS "key", up AS key_position, ct AS key_type, cn AS key_name,
        m.definition, m.ss AS source_schema, m.st AS source_entity
      FROM src m JOIN cls k ON k.relname = m.matviewname AND k.nspname = m.schemaname AND k.relkind = 'm'
        JOIN pg_attribute a ON a.attrelid = k.oid AND a.attnum >= 1
        JOIN columns c ON c.column_name = a.attname AND c.table_schema = m.ss AND c.table_name = m.st
        LEFT JOIN idx i ON i.relname = c.table_name AND i.attname = c.column_name AND i.nspname = c.table_schema
        LEFT JOIN ent_txt e ON e.relname = c.table_name {'AND e.nspname = c.table_schema' if strict else ''}
        LEFT JOIN col_txt d ON d.nspname = c.table_schema AND d.relname = c.table_name AND d.objsubid = a.attnum
        LEFT JOIN key_use ON uc = c.column_name AND us = c.table_schema {'AND ut = c.table_name' if strict else ''}
        LEFT JOIN sch_txt h ON h.nspname = m.schemaname"""


_SRC = {**_NAMED, "src": r"""SELECT *, regexp_extract(definition, '(?s)FROM (\w+)\.(\w+)(?: AS)? (.+)', 1) AS ss,
    regexp_extract(definition, '(?s)FROM (\w+)\.(\w+)(?: AS)? (.+)', 2) AS st FROM matviews"""}
_MAT = ["matviews", *_CATALOG[1:9]]
ORACLES["matview_columns"] = oracle(_matviews(True), *_MAT, extra=_SRC)
ORACLES["matview_columns_loose"] = oracle(
    f"SELECT fqdn, position, key_name, entity_comment FROM ({_matviews(False)})", *_MAT, extra=_SRC)
_FK = """SELECT DISTINCT d.description AS comment, concat_ws('.', u.table_schema, u.table_name, u.column_name) AS foreign_fqdn,
    u.table_schema AS foreign_field_schema, u.table_name AS foreign_field_entity, u.column_name AS foreign_field_name,
    c.ordinal_position AS col_id, concat_ws('.', p.table_schema, p.table_name, p.column_name) AS source_fqdn,
    p.table_schema AS source_field_schema, p.table_name AS source_field_entity, p.column_name AS source_field_name,
    u.ordinal_position AS key_number, u.constraint_name AS name, lower(r.match_option) AS on_match,
    lower(r.update_rule) AS on_update, lower(r.delete_rule) AS on_delete, lower(t.constraint_type) AS type
  FROM key_column_usage u JOIN table_constraints t USING (constraint_schema, constraint_name)
    JOIN columns c ON c.table_schema = u.table_schema AND c.table_name = u.table_name AND c.column_name = u.column_name
    JOIN referential_constraints r ON r.constraint_name = u.constraint_name AND r.constraint_schema = u.table_schema
    JOIN key_column_usage p ON p.constraint_name = r.unique_constraint_name AND p.constraint_schema = r.unique_constraint_schema
      AND p.ordinal_position = u.position_in_unique_constraint
    LEFT JOIN pg_class k ON k.relname = r.constraint_name LEFT JOIN pg_stat_all_indexes s ON s.indexrelid = k.oid
    LEFT JOIN pg_constraint q ON q.conrelid = s.relid AND q.conname = u.constraint_name
    LEFT JOIN description d ON d.objoid = q.oid
  WHERE t.constraint_type = 'FOREIGN KEY'"""
_FK_TABLES = ["columns", "key_column_usage", "table_constraints", "referential_constraints", "pg_class", "pg_stat_all_indexes",
              "pg_constraint", "description"]
ORACLES["fk_resolution"] = oracle(_FK, *_FK_TABLES)
ORACLES["fk_documents"] = oracle("""SELECT name AS physical_nm, name AS logical_nm, rn - 1 AS part,
    first_value(ps) OVER w AS parent_set, first_value(cs) OVER w AS child_set, on_update, on_delete,
    ps || '.' || pc || '>' || cs || '.' || cc AS items
  FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY """ + _bucket("key_number", "ps || '.' || pc", "cs || '.' || cc")
    + """, key_number, ps || '.' || pc, cs || '.' || cc) AS rn,
      row_number() OVER (PARTITION BY name ORDER BY key_number, cs || '.' || cc, ps || '.' || pc) AS hn FROM (
      SELECT name, min(key_number) AS key_number, source_field_schema || '.src:' || source_field_entity AS ps,
        source_field_name AS pc, foreign_field_schema || '.src:' || foreign_field_entity AS cs, foreign_field_name AS cc,
        upper(min(on_update)) AS on_update, upper(min(on_delete)) AS on_delete FROM fk GROUP BY ALL))
  WINDOW w AS (PARTITION BY name ORDER BY hn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    *_FK_TABLES, extra={"fk": _FK})

# --- profiles ----------------------------------------------------------------------------------

_NULLED = """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, CASE WHEN l_orderkey % 4 <> 0 THEN l_shipdate END AS l_shipdate,
    CASE WHEN l_linenumber > 6 THEN l_linestatus END AS l_linestatus FROM lineitem"""
_NULL_COLS = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate", "l_linestatus")


def _shares(cols, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS item, round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 9) AS null_percentage FROM {source}"
        for c in cols)


def _common(shown: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS item, v AS most_common_value, n AS frequency FROM (SELECT 1) LEFT JOIN (
          SELECT {e} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1
          ORDER BY n DESC, v LIMIT 1) ON true""" for c, e in shown.items())


ORACLES["profile_nulls"] = f"WITH t AS ({_NULLED}) {_shares(_NULL_COLS, 't')}"
_SHOWN = {c: f"CAST({c} AS VARCHAR)" for c in _NULL_COLS}
_SHOWN |= {"l_shipdate": "strftime(l_shipdate, '%Y-%m-%d')", "l_quantity": "CAST(CAST(l_quantity AS INT) AS VARCHAR)"}
ORACLES["profile_mcv"] = f"WITH t AS ({_NULLED}) {_common(_SHOWN, 't')}"
_DOC_COLS = ("doc_id", "lang", "source", "text")
ORACLES["profile_documents"] = f"""SELECT item, null_percentage, most_common_value FROM ({_shares(_DOC_COLS, 'documents')})
  JOIN ({_common({c: f'CAST({c} AS VARCHAR)' for c in _DOC_COLS}, 'documents')}) USING (item)"""
_EVENT_KEYS = """SELECT event_type AS a, 'u' || user_id % 7 AS b,
    concat('{"', event_type, '":1,"u', user_id % 7, '":2}') AS j FROM events WHERE event_id % 50 <> 0 AND event_id % 51 <> 0"""
ORACLES["json_keys_full"] = f"SELECT DISTINCT 'props' AS source, unnest([a, b]) AS attribute FROM ({_EVENT_KEYS})"
ORACLES["json_keys_compat"] = f"""SELECT DISTINCT 'props' AS source, unnest([a, b]) AS attribute FROM (
    SELECT * FROM ({_EVENT_KEYS}) ORDER BY greatest(a, b) DESC, j DESC LIMIT 1)"""
_TABLE_KEYS = f"""SELECT 'lake' AS schema, 'Events' AS dataset_id, 'props' AS source, unnest(json_keys(props)) AS a FROM events
  UNION SELECT 'lake', 'parts', 'extra', unnest([a, b]) FROM ({_EVENT_KEYS})
  UNION SELECT 'lake', 'parts', 'props', 'p' || user_id % 5 FROM events WHERE event_id % 4 = 0
  UNION SELECT 'web', 'docs', 'doc', 'l_' || lang FROM documents"""
ORACLES["json_expansion_tables"] = f"""SELECT schema, dataset_id, source, source || '::' || a AS physical_nm, 'text' AS type, false AS identity,
    true AS nullable, schema || '.' || dataset_id || '.' || a AS fqdn, '{{"source":"' || source || '"}}' AS metadata FROM ({_TABLE_KEYS})"""
ORACLES["json_expansion_tables_compat"] = f"""SELECT 'parts' AS dataset_id, 'extra::' || attribute AS physical_nm FROM ({ORACLES['json_keys_compat']})
  UNION SELECT 'parts', 'props::' || max('p' || user_id % 5) FROM events WHERE event_id % 4 = 0
  UNION SELECT 'docs', 'doc::l_' || max(lang) FROM documents
  UNION SELECT 'Events', 'props::' || unnest(k) FROM (SELECT json_keys(props) AS k FROM events ORDER BY list_max(json_keys(props)) DESC, props DESC LIMIT 1)"""
ORACLES["json_expansion_keys"] = f"""SELECT DISTINCT schema, dataset_id, lower(dataset_id) || '_json_expansion_key' AS name, 'json' AS type,
    'Generated by JSON autoexpansion of the ' || dataset_id || ' item.' AS comment, source AS item FROM ({_TABLE_KEYS})"""
ORACLES["json_expansion"] = f"""SELECT 'Events' AS dataset_id, src || '::' || a AS physical_nm, 'text' AS type, false AS identity,
    true AS nullable, 'lake.Events.' || a AS fqdn, '{{"source":"' || src || '"}}' AS metadata FROM (
      SELECT DISTINCT 'props' AS src, unnest([a, b]) AS a FROM ({_EVENT_KEYS})
      UNION SELECT 'raw', unnest(json_keys(props)) FROM events)"""
ORACLES["stats_enrich"] = oracle("""SELECT upper(c.table_schema) AS schema, upper(c.table_name) AS dataset_id,
    c.column_name || x AS physical_nm, CASE WHEN x = '' THEN coalesce(most_common_vals[1], udt_name) ELSE udt_name END AS example,
    CASE WHEN x = '' THEN null_frac * 100 END AS null_percentage,
    CASE WHEN x = '' THEN coalesce(most_common_vals[1], 'NULL') END AS most_common_value
  FROM columns c JOIN stats s ON s.schemaname = c.table_schema AND s.tablename = c.table_name AND s.attname = c.column_name,
    (SELECT unnest(['', '_x']) AS x)""", "columns", "stats")

# --- merges and documents ------------------------------------------------------------------------

ORACLES["merge_sets"] = oracle("""SELECT lower(coalesce(a.schema, b.schema)) AS schema_id, lower(coalesce(a.physical_nm, b.physical_nm)) AS set_id,
    coalesce(a.physical_nm, upper(b.physical_nm)) AS physical_nm, coalesce(a.logical_nm, b.logical_nm) AS logical_nm,
    coalesce(a.schema, b.schema) AS schema, CASE WHEN a.physical_nm IS NULL THEN b.type ELSE a.type END AS type,
    CASE WHEN a.physical_nm IS NULL THEN b.definition ELSE a.definition END AS definition,
    CASE WHEN a.physical_nm IS NULL THEN b.id END AS id,
    coalesce(nullif(b.description, ''), a.description, '') AS description
  FROM wdb_dataset a FULL JOIN wdh_dataset b ON b.physical_nm = a.physical_nm""", "wdb_dataset", "wdh_dataset")
ORACLES["merge_schemas"] = """SELECT lower(s) AS schema_id, arg_min(s, p_partkey) AS schema,
    arg_min(p_name, p_partkey) FILTER (p_partkey % 3 = 0) AS comment
  FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN concat('sch_', p_size % 5) ELSE concat('SCH_', p_size % 5) END AS s FROM part)
  GROUP BY lower(s)"""
_MERGED_ITEM = ("logical_nm", "type", "is_pk", "key_nm", "nullable", "example", "default_val")
ORACLES["merge_items"] = oracle(f"""SELECT coalesce(a.dataset_id, b.dataset_id) AS set_id, coalesce(a.physical_nm, b.physical_nm) AS item_id,
    coalesce(a.dataset_id, b.dataset_id) AS dataset_id, coalesce(a.physical_nm, upper(b.physical_nm)) AS physical_nm,
    {', '.join(f'CASE WHEN a.physical_nm IS NULL THEN b.{c} ELSE a.{c} END AS {c}' for c in _MERGED_ITEM)},
    coalesce(nullif(b.description, ''), a.description, '') AS description
  FROM wdb_dataitem a FULL JOIN wdh_dataitem b ON b.dataset_id = a.dataset_id AND b.physical_nm = a.physical_nm""",
    "wdb_dataitem", "wdh_dataitem")
_KEYROWS = """SELECT *, concat('ds_', l_partkey) AS dataset_id,
    CASE WHEN l_orderkey % 2 = 0 THEN concat('PK_', l_linenumber) ELSE concat('pk_', l_linenumber) END AS name,
    CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS t, CASE WHEN l_orderkey % 7 <> 0 THEN l_linestatus END AS c FROM lineitem"""
_SEQ = f"row_number() OVER (ORDER BY l_orderkey, {', '.join(ORDER)})"
ORACLES["merge_keys"] = f"""SELECT dataset_id, lower(name) AS key_id, arg_min(name, seq) AS name, arg_min(t, seq) AS type,
    arg_max(c, seq) AS comment FROM (SELECT *, {_SEQ} AS seq FROM ({_KEYROWS})) GROUP BY dataset_id, lower(name)"""
ORACLES["merge_key_items"] = f"""SELECT dataset_id, lower(name) AS key_id, concat('c_', l_suppkey % 10) AS item, min(l_orderkey) AS first_seen
  FROM ({_KEYROWS}) GROUP BY ALL"""
_RELROWS = """SELECT *, concat('fk_', o_orderkey) AS rel, concat('ds_', o_custkey) AS owner1,
    concat('ds_', o_custkey + CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END) AS owner2,
    CASE WHEN o_orderkey % 2 = 0 THEN concat('R', o_orderkey) END AS id1,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 22 = 0 THEN 'X' ELSE concat('R', o_orderkey) END AS id2 FROM orders"""
ORACLES["merge_relationships"] = f"""SELECT rel AS relationship_id, rel AS physical_nm, owner1 AS dataset_id, coalesce(id1, id2) AS id,
    'foreign key' AS type, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE o_orderstatus END AS comment,
    CASE WHEN o_orderkey % 3 = 0 THEN 'set null' ELSE 'cascade' END AS on_update,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'restrict' END AS on_delete, {NONE} AS on_match FROM ({_RELROWS})"""
ORACLES["relationship_conflicts"] = f"""SELECT rel AS relationship_id, 'different ids' AS reason FROM ({_RELROWS}) WHERE id1 <> id2
  UNION ALL SELECT rel, 'different types' FROM ({_RELROWS}) WHERE o_orderkey % 27 = 0
  UNION ALL SELECT rel, 'different sets' FROM ({_RELROWS}) WHERE owner1 <> owner2"""
ORACLES["merge_joins"] = oracle("""SELECT db_relationship_id AS relationship_id, parent_fqdn || '::' || child_fqdn AS join_id,
    db_relationship_id, parent_fqdn, child_fqdn, coalesce(nullif(b.position, 0), a.position, 0) AS position,
    coalesce(nullif(b.cardinality, ''), nullif(a.cardinality, ''), '') AS cardinality
  FROM wdb_join a FULL JOIN wdh_join b USING (db_relationship_id, parent_fqdn, child_fqdn)""", "wdb_join", "wdh_join")


def _links(table: str) -> str:
    return f"""SELECT DISTINCT db_relationship_id AS relationship_id, role, split_part(f, '.', 2) AS set_id,
        role || '=' || db_relationship_id AS link
      FROM (SELECT db_relationship_id, 'parent' AS role, parent_fqdn AS f FROM {table}
        UNION ALL SELECT db_relationship_id, 'child', child_fqdn FROM {table})"""


ORACLES["set_links"] = oracle(_links("wdb_join"), "wdb_join")
ORACLES["dangling_links"] = oracle(f"""SELECT * FROM ({_links('dh_join')})
  WHERE relationship_id NOT IN (SELECT physical_nm FROM db_relationship)""", "dh_join", "db_relationship")
ORACLES["linked_relationships"] = oracle(f"""SELECT DISTINCT set_id, relationship_id, id, on_delete FROM ({_links('wdb_join')})
  JOIN wdh_relationship ON physical_nm = relationship_id""", "wdb_join", "wdh_relationship")
ORACLES["document_roundtrip"] = oracle("FROM wdb_dataitem", "wdb_dataitem")
ORACLES["document_sets"] = oracle("FROM wdb_dataset", "wdb_dataset")
ORACLES["document_relationships"] = oracle("SELECT *, 'sch_0' AS schema FROM wdb_relationship", "wdb_relationship")
ORACLES["document_joins"] = oracle("""SELECT * FROM wdb_join WHERE db_relationship_id IN (SELECT physical_nm FROM wdb_relationship)""",
                                   "wdb_join", "wdb_relationship")
ORACLES["items_by_type"] = oracle("""SELECT wanted, dataset_id, physical_nm, type
  FROM (SELECT unnest(['_int4', 'text', 'json']) AS wanted) LEFT JOIN wdb_dataitem ON lower(type) = wanted""", "wdb_dataitem")
ORACLES["views_nonviews"] = oracle("""SELECT CASE WHEN upper(coalesce(type, '')) LIKE '%VIEW%' THEN 'view' ELSE 'other' END AS kind,
    physical_nm, type FROM wdb_dataset""", "wdb_dataset")

# --- flows -----------------------------------------------------------------------------------

_FLAT = """SELECT c.table_schema AS s, c.table_name AS t, c.column_name AS c, coalesce(d.description, '') AS txt, c.udt_name AS ty,
    coalesce(column_default, 'NULL') AS df, coalesce(c.is_nullable = 'YES', false) AS nul, c.table_schema AS ks, c.table_name AS kt
  FROM columns c JOIN tables USING (table_schema, table_name)
    LEFT JOIN cls ON cls.nspname = c.table_schema AND cls.relname = c.table_name AND relkind IN ('r', 't', 'm')
    LEFT JOIN description d ON d.objoid = cls.oid AND d.objsubid = c.ordinal_position
  UNION ALL SELECT m.schemaname, m.matviewname, a.attname, coalesce(d.description, ''), c.udt_name, coalesce(column_default, 'NULL'),
    coalesce(c.is_nullable = 'YES', false), c.table_schema, c.table_name
  FROM src m JOIN cls k ON k.relname = m.matviewname AND k.nspname = m.schemaname AND k.relkind = 'm'
    JOIN pg_attribute a ON a.attrelid = k.oid AND a.attnum >= 1
    JOIN columns c ON c.column_name = a.attname AND c.table_schema = m.ss AND c.table_name = m.st
    LEFT JOIN cls ON cls.nspname = c.table_schema AND cls.relname = c.table_name AND cls.relkind IN ('r', 't', 'm')
    LEFT JOIN description d ON d.objoid = cls.oid AND d.objsubid = a.attnum"""
ORACLES["source_snapshot_items"] = oracle("""SELECT t AS dataset_id, c AS physical_nm, '' AS logical_nm, ty AS type, min(txt) AS description,
    min(pk) IS NOT NULL AS is_pk, coalesce(min(pk), '') AS key_nm, bool_and(nul) AS nullable,
    coalesce(min(most_common_vals[1]), '') AS example, min(df) AS default_val,
    min(CASE WHEN null_frac IS NOT NULL THEN concat('{"most_common_value":"', coalesce(most_common_vals[1], 'NULL'),
      '","null_percentage":', null_frac * 100, '}') END) AS metadata
  FROM flat LEFT JOIN (SELECT us, ut, uc, up, cn AS k, ct FROM key_use) u ON us = ks AND ut = kt AND uc = c
    LEFT JOIN idx i ON i.nspname = ks AND i.relname = kt AND i.attname = c
    LEFT JOIN stats ON schemaname = s AND tablename = t AND stats.attname = c,
    LATERAL (SELECT CASE WHEN uc IS NOT NULL AND (indisprimary OR ct LIKE '%primary%') THEN coalesce(k, '') END AS pk)
  GROUP BY s, t, c, ty""", "stats", *_MAT, *_CATALOG, extra={**_SRC, "flat": _FLAT})
ORACLES["relationships_only"] = oracle(f"""SELECT 'delete' AS phase, physical_nm, id AS target_id, 0 AS part, CAST(NULL AS BIGINT) AS n_items
    FROM (SELECT DISTINCT physical_nm, id FROM ({_REL_DOC})) WHERE physical_nm NOT IN (SELECT name FROM fk)
  UNION ALL SELECT 'upsert', name, NULL, 0, count(DISTINCT source_fqdn || '>' || foreign_fqdn) FROM fk GROUP BY name""",
    *_FK_TABLES, extra={"fk": _FK})
