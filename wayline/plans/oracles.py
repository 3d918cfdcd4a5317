"""SQL twins of the registered queries, for the same tables in another engine."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_HASH = "((({0}) % 2147483648) * 2654435761) % 4294967296"


def _dotted(ip: str) -> str:
    return "concat_ws('.', " + ", ".join(f"(({ip}) // {d}) % 256" for d in (16777216, 65536, 256, 1)) + ")"


def _lat(key: str) -> str:
    return f"((({key})*37) % 720) * 0.25::DOUBLE - 90"


def _lon(key: str) -> str:
    return f"((({key})*53) % 1440) * 0.25::DOUBLE - 180"


def _words(text: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(strip_accents(lower({text})), "
        "'[^\\p{L}\\p{N}\\p{Co}]+'), lambda t: t <> '')"
    )


_IPS = f"ips AS (SELECT event_id, {_HASH.format('event_id')} AS ip FROM events)"

_WIDTH = "width AS (SELECT count(*) AS n, 4294967296 // count(*) AS w, max(c_custkey) AS last_key FROM customer)"

_PROBES = f"""{_WIDTH}, probe_ints AS (
  SELECT event_id, event_type, CASE WHEN event_id % 10 = 0
    THEN least(((event_id % n) + 1) * w - 1, 4294967295) - CASE WHEN (event_id % n) % 5 = 0 THEN 1000 ELSE 0 END
    ELSE {_HASH.format('event_id')} END AS ip_all FROM events, width),
probes AS (
  SELECT event_id, event_type,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE ip_all END AS ip_int,
    CASE WHEN event_id % 97 = 0 THEN 'not an address' WHEN event_id % 89 <> 0 THEN {_dotted('ip_all')} END AS ip
  FROM probe_ints)"""

_RAW_RANGES = f"""copies AS (SELECT unnest([0, 1]) AS copy), raw_ranges AS (
  SELECT c_custkey * w AS ip_from,
    CASE WHEN c_custkey = last_key THEN 4294967295 ELSE (c_custkey + 1) * w - 1 END
      - CASE WHEN c_custkey % 5 = 0 THEN 1000 ELSE 0 END AS ip_to,
    upper(n_name) AS country_code, upper(c_mktsegment) AS country_name, upper(c_name) AS region_name,
    'PLACE ' || (c_custkey % 97)::VARCHAR AS place_name,
    {_lat('c_custkey + copy * 11')} AS latitude, {_lon('c_custkey + copy * 11')} AS longitude,
    c_custkey::VARCHAR AS zip_code, c_custkey * 2 + copy AS row_id
  FROM customer CROSS JOIN width LEFT JOIN nation ON c_nationkey = n_nationkey
  JOIN copies ON copy = 0 OR c_custkey % 7 = 0)"""


def _answers(name: str, rows: str, keys: str, attributes: str) -> str:
    """CTEs for first row, location and representative point per key."""
    extra = f", {attributes}" if attributes else ""
    join = " AND ".join(f"c.{k.strip()} = r.{k.strip()}" for k in keys.split(","))
    using = keys
    return f"""{name}_center AS (
  SELECT {keys}, sum(latitude) / count(*) AS c_lat, sum(longitude) / count(*) AS c_lon FROM {rows} GROUP BY {keys}),
{name}_first AS (
  SELECT {keys}{extra}, latitude || ',' || longitude AS location FROM {rows}
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY row_id) = 1),
{name}_near AS (
  SELECT {", ".join("r." + k.strip() for k in keys.split(","))}, latitude || ',' || longitude AS representative_point
  FROM {rows} r JOIN {name}_center c ON {join}
  QUALIFY row_number() OVER (PARTITION BY {", ".join("r." + k.strip() for k in keys.split(","))}
    ORDER BY (latitude - c_lat) * (latitude - c_lat) + (longitude - c_lon) * (longitude - c_lon), row_id) = 1),
{name} AS (SELECT * FROM {name}_first JOIN {name}_near USING ({using}))"""


_RANGES = f"{_RAW_RANGES}, {_answers('ranges', 'raw_ranges', 'ip_to', 'ip_from, country_code, country_name, region_name, place_name, zip_code')}"

_GEO_IP_COLUMNS = ", ".join(
    f"r.{c} AS geo_{c}"
    for c in ("country_code", "country_name", "place_name", "region_name", "zip_code", "location", "representative_point")
)

_POINTS = f"""points AS (
  SELECT {_lat('p_partkey')} AS latitude, {_lon('p_partkey')} AS longitude, upper(p_brand) AS country_code,
    upper(p_type) AS country_name, p_partkey AS row_id FROM part)"""

_KEY_PROBES = """key_probes AS (
  SELECT event_id, 'Brand#' || (event_id % 30)::VARCHAR AS brand,
    CASE WHEN event_id % 7 = 0 THEN 'tiny' WHEN event_id % 3 = 0 THEN 'Economy' ELSE 'promo' END AS kind,
    CASE WHEN event_id % 2 = 0 THEN 'brand#' || (event_id % 30)::VARCHAR END AS maybe_brand,
    CASE WHEN event_id % 3 = 0 THEN 'Economy' END AS maybe_kind FROM events)"""

_VALUE = "value::VARCHAR"
_SIZE = f"""CASE WHEN event_id % 19 = 0 THEN 'abc' WHEN event_id % 7 = 0 THEN 'nan' WHEN event_id % 11 = 0 THEN ''
    WHEN event_id % 23 = 0 THEN {_VALUE} || 'd' WHEN event_id % 29 = 0 THEN '1_000'
    WHEN event_id % 31 = 0 THEN ' ' || {_VALUE} || ' ' ELSE {_VALUE} END"""
_NUMBER = """CASE WHEN event_id % 19 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 23 = 0 THEN NULL
    WHEN event_id % 29 = 0 THEN 1000.0 ELSE value END"""
_MS = "epoch_us(ts) // 1000"
# A short line that ends in a padded size loses the padding at its right end.
_FIELDS = f"""fields AS (
  SELECT event_id, {_MS} AS ms, CASE WHEN event_id % 17 = 0 THEN rtrim({_SIZE}, ' ') ELSE {_SIZE} END AS size,
    {_NUMBER} AS number, CASE WHEN event_id % 17 <> 0 THEN event_type END AS kind,
    event_id % 13 = 0 AND event_id % 17 <> 0 AS too_many FROM events WHERE event_id % 13 <> 0 OR event_id % 17 <> 0
  UNION ALL
  SELECT event_id, {_MS}, {_SIZE}, {_NUMBER}, 'x', TRUE FROM events WHERE event_id % 13 = 0 AND event_id % 17 = 0)"""
_LINES = f"""lines AS (
  SELECT event_id AS ordinal, event_id::VARCHAR || ';' || ({_MS})::VARCHAR || ';' || ({_SIZE})
    || CASE WHEN event_id % 17 = 0 THEN '' ELSE ';' || event_type END
    || CASE WHEN event_id % 13 = 0 THEN ';x;y' ELSE '' END
    || CASE WHEN event_id % 3 = 0 THEN ' ' || chr(9) ELSE '' END AS value FROM events)"""

ORACLES["ip_to_int"] = f"WITH {_PROBES} SELECT event_id, ip, ip_int FROM probes"
ORACLES["int_to_ip"] = f"WITH {_IPS} SELECT event_id, {_dotted('ip')} AS ip FROM ips"
ORACLES["cidr_filter"] = f"""WITH {_IPS} SELECT event_id, ip FROM ips
WHERE ip // 134217728 = 20 OR ip // 16777216 = 10"""
ORACLES["nan_inf"] = """SELECT event_id,
  event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 AS nan_or_inf FROM events"""
ORACLES["date_ms"] = """SELECT event_id, (event_id + 1519995883) * 1000 + 309 AS from_seconds,
  event_id + 1519995883 AS as_ms FROM events"""
ORACLES["date_suffix"] = """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN ((event_id + 1519995883) * 1000 + 250)::VARCHAR
  WHEN event_id % 9 <> 0 THEN (event_id + 1519995883)::VARCHAR || '000' END AS ms_text FROM events"""
ORACLES["location_fmt"] = f"""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '0.0005' WHEN p_partkey % 5 = 0 THEN '-5e-05'
  ELSE ({_lat('p_partkey')})::VARCHAR END || ',' || CASE WHEN p_partkey % 11 <> 0 THEN ({_lon('p_partkey')})::VARCHAR END AS location
FROM part"""
ORACLES["tokenize"] = f"SELECT doc_id, array_to_string({_words('text')}, ' ') AS words FROM documents"
ORACLES["doc_id"] = """SELECT event_id, md5(to_json({'event_type': event_type, 'user_id': user_id,
  'props': CASE WHEN event_id % 4 <> 0 THEN props END})::VARCHAR) AS _id FROM events"""

ORACLES["scan_lines"] = f"WITH {_LINES} SELECT value FROM lines"
ORACLES["skip_header"] = f"""WITH {_LINES} SELECT replace(value, ';abc;', ';"abc;') AS value FROM lines"""
ORACLES["stream_lines"] = f"WITH {_FIELDS} SELECT event_id AS id, ms AS at, number AS size, kind FROM fields WHERE NOT too_many"
_NUM = "(event_id % 2147483648)"
ORACLES["gen_lines"] = f"""SELECT event_id AS id, concat_ws(';', (event_id * 1000 + 1577836800000)::VARCHAR,
  printf('%.2f,%.2f', (({_NUM} * 7727) % 18001 - 9000) / 100.0, (({_NUM} * 15667) % 36001 - 18000) / 100.0),
  {_dotted(f'({_NUM} * 2654435761 + 12345) % 4294967296')}, 'service-' || ({_NUM} % 40)::VARCHAR,
  'request ' || event_id::VARCHAR || ' answered by node ' || ({_NUM} % 97)::VARCHAR,
  (({_NUM} * 7919) % 5 * 100 + 100)::VARCHAR, printf('%.3f', (({_NUM} * 104729) % 9999991) / 1000.0)) AS value FROM events"""
ORACLES["tor_set_load"] = f"SELECT DISTINCT {_HASH.format('event_id % 5000')} AS ip_int FROM events WHERE event_id % 13 <> 0"
ORACLES["tor_export_filter"] = f"""WITH {_IPS} SELECT {_dotted('ip')} AS "IP Address" FROM ips WHERE event_id % 50 = 0"""

_CODE = """CASE WHEN p_partkey % 11 = 0 THEN 'NA' WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN NULL
  ELSE upper(p_brand) END"""
ORACLES["dim_country"] = f"""SELECT {_lat('p_partkey')} AS latitude, {_lon('p_partkey')} AS longitude, {_CODE} AS country_code,
  upper(p_type || ', ' || p_name) AS country_name FROM part"""
ORACLES["dim_ip_range"] = f"""WITH {_WIDTH}, {_RANGES} SELECT ip_to, ip_from, country_code, country_name, place_name, region_name,
  zip_code, location, representative_point, TRUE AS disjoint FROM ranges"""

_PLACES = f"""places AS (
  SELECT upper(p_brand) AS country_code, p_partkey::VARCHAR AS zip_code, upper(p_name) AS place_name,
    upper(p_type) AS admin_name1, 'A' || (p_partkey % 50)::VARCHAR AS admin_code1,
    NULL::VARCHAR AS admin_name2, NULL::VARCHAR AS admin_code2, NULL::VARCHAR AS admin_name3, NULL::VARCHAR AS admin_code3,
    {_lat('p_partkey')} AS latitude, {_lon('p_partkey')} AS longitude, p_size::DOUBLE AS accuracy,
    p_partkey AS row_id FROM part)"""
_INDEXED = ("country_code", "zip_code", "place_name", "admin_name1", "admin_code1", "latitude", "longitude", "accuracy")
_COLUMN_WORDS = "\n  UNION ALL ".join(
    f"SELECT row_id, '{c}' AS col, unnest({_words(c + '::VARCHAR')}) AS word FROM places" for c in _INDEXED
)
_POSTINGS = f"""column_words AS ({_COLUMN_WORDS}),
postings AS (SELECT DISTINCT row_id, col || ':' || word AS term FROM column_words
  UNION SELECT DISTINCT row_id, '*:' || word FROM column_words)"""
ORACLES["term_frequency"] = f"WITH {_PLACES}, {_POSTINGS} SELECT term, count(*) AS n FROM postings GROUP BY term"
ORACLES["dim_place"] = f"""WITH {_PLACES}, {_POSTINGS}, terms AS (
  SELECT row_id, string_agg(term, ' ' ORDER BY term) AS terms FROM postings GROUP BY row_id)
SELECT places.* EXCLUDE (row_id), terms FROM places JOIN terms USING (row_id)"""

ORACLES["parse_lines"] = f"""WITH {_FIELDS} SELECT event_id AS ordinal, event_id::VARCHAR AS id, ms::VARCHAR AS at, size, kind
FROM fields WHERE NOT too_many"""
ORACLES["parse_untyped"] = ORACLES["parse_lines"]
ORACLES["typed_cast"] = f"""SELECT event_id AS ordinal, trunc({_NUMBER})::INTEGER AS as_integer, trunc({_NUMBER})::BIGINT AS as_long,
  {_NUMBER} AS as_float, {_SIZE} || CASE WHEN event_id % 17 = 0 AND event_id % 13 <> 0 AND event_id % 3 = 0 THEN ' ' || chr(9) ELSE '' END
  AS as_keyword FROM events"""
ORACLES["parse_typed"] = f"""WITH {_FIELDS} SELECT event_id AS ordinal, event_id AS id, ms AS at, number AS size, kind
FROM fields WHERE NOT too_many"""
ORACLES["extra_cols"] = f"""WITH {_FIELDS} SELECT event_id AS ordinal, event_id::VARCHAR AS id, ms::VARCHAR AS at, size,
  'fixed' AS kind, 'mail' AS service FROM fields WHERE NOT too_many"""
ORACLES["rejects"] = f"""WITH {_FIELDS}, {_LINES} SELECT ordinal, value AS line,
  CASE WHEN too_many THEN 'too many fields' ELSE 'missing id field' END AS reason
FROM fields JOIN lines ON ordinal = event_id WHERE too_many OR kind IS NULL"""
ORACLES["rejects_topn"] = f"""WITH {_FIELDS}, {_LINES} SELECT ordinal, value AS line, 'too many fields' AS reason
FROM fields JOIN lines ON ordinal = event_id WHERE too_many ORDER BY ordinal LIMIT 100"""
ORACLES["reject_policy"] = f"WITH {_FIELDS} SELECT kind, count(*) AS n FROM fields WHERE NOT too_many GROUP BY kind"
ORACLES["load_report"] = f"""WITH {_FIELDS} SELECT count(*) AS lines, count(*) FILTER (NOT too_many) AS success,
  count(*) FILTER (too_many) AS failed,
  count(*) FILTER (event_id % 19 = 0 OR event_id % 23 = 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0) AS bad_fields FROM fields"""

ORACLES["first_per_key"] = f"""WITH {_POINTS}, {_answers('found', 'points', 'country_code', 'country_name')}
SELECT country_code, country_name, location FROM found"""
ORACLES["repr_point"] = f"""WITH {_POINTS}, {_answers('found', 'points', 'country_code', 'country_name')}
SELECT country_code, representative_point FROM found"""
ORACLES["country_by_code"] = f"""WITH {_POINTS}, {_answers('found', 'points', 'country_code', 'country_name')}
SELECT country_code, country_name, location, representative_point FROM found WHERE country_code = 'BRAND#12'"""
_COUNTRY_COLUMNS = ", ".join(f"f.{c} AS geo_{c}" for c in ("country_code", "country_name", "location", "representative_point"))
ORACLES["geo_country"] = f"""WITH {_POINTS}, {_KEY_PROBES}, {_answers('f', 'points', 'country_code, country_name', '')}
SELECT event_id, brand, kind, {_COUNTRY_COLUMNS} FROM key_probes
LEFT JOIN f ON f.country_code = upper(brand) AND f.country_name = upper(kind)"""

# Key-tuple lookups: match rows per distinct tuple, then answer per tuple.
_TUPLES = "tuples AS (SELECT DISTINCT {a} AS qa, {b} AS qb FROM {source})"


def _tuple_lookup(source: str, a: str, b: str, condition: str, table: str, attributes: str, columns: str, tuple_a: str, tuple_b: str) -> str:
    qualified = ", ".join(f"t.{c.strip()}" for c in attributes.split(","))
    return f"""tuples AS (SELECT DISTINCT coalesce({tuple_a}, '~') AS qa, coalesce({tuple_b}, '~') AS qb FROM {source}),
matches AS (SELECT qa, qb, {qualified}, t.latitude, t.longitude, t.row_id FROM tuples JOIN {table} t ON {condition}),
{_answers('f', 'matches', 'qa, qb', attributes)}
SELECT event_id, {a}, {b}, {columns} FROM {source}
LEFT JOIN f ON qa = coalesce({tuple_a}, '~') AND qb = coalesce({tuple_b}, '~')"""


ORACLES["geo_country_dynamic"] = f"""WITH {_POINTS}, {_KEY_PROBES}, """ + _tuple_lookup(
    "key_probes", "maybe_brand", "maybe_kind",
    "(qa = '~' OR qa = t.country_code) AND (qb = '~' OR qb = t.country_name) AND NOT (qa = '~' AND qb = '~')",
    "points", "country_code, country_name", _COUNTRY_COLUMNS, "upper(maybe_brand)", "upper(maybe_kind)",
)
ORACLES["lookup_or"] = f"""WITH {_POINTS}, {_KEY_PROBES}, """ + _tuple_lookup(
    "key_probes", "maybe_brand", "kind", "qa = t.country_code OR qb = t.country_name",
    "points", "country_code, country_name", _COUNTRY_COLUMNS, "upper(maybe_brand)", "upper(kind)",
)
_RANGE_PLACE = "country_code, country_name, place_name, region_name, zip_code"
ORACLES["geo_range_by_key"] = f"""WITH {_WIDTH}, {_RAW_RANGES}, key_probes AS (
  SELECT event_id, 'nation_' || (event_id % 27)::VARCHAR AS nation, 'place ' || (event_id % 101)::VARCHAR AS place FROM events), """ + _tuple_lookup(
    "key_probes", "nation", "place", "qa = t.country_code AND qb = t.place_name", "raw_ranges", _RANGE_PLACE,
    _GEO_IP_COLUMNS.replace("r.", "f."), "upper(nation)", "upper(place)",
)

ORACLES["geo_ip"] = f"""WITH {_PROBES}, {_RANGES} SELECT event_id, event_type, ip, {_GEO_IP_COLUMNS}
FROM probes LEFT JOIN ranges r ON ip_int BETWEEN ip_from AND ip_to"""
ORACLES["geo_ip_large"] = ORACLES["geo_ip"]


def _sized_ranges(name: str, start: str, end: str) -> str:
    return f"""{name} AS (SELECT ({start})::BIGINT AS ip_from, ({end})::BIGINT AS ip_to, upper(c_name) AS country_code,
  upper(c_mktsegment) AS country_name, 'R' AS region_name, 'PLACE ' || (key % 97)::VARCHAR AS place_name, key::VARCHAR AS zip_code,
  ({_lat('key')}) || ',' || ({_lon('key')}) AS location, ({_lat('key')}) || ',' || ({_lon('key')}) AS representative_point
  FROM (SELECT c_custkey AS key, c_name, c_mktsegment, w FROM customer, width) WHERE ({end}) < 4294967296)"""


_OVERLAPPING = _sized_ranges(
    "overlapping", "CASE WHEN key % 100 = 0 THEN 0 ELSE greatest(0, key - key % 4) * w + key % 5 * 100 END",
    "(key + 1 + key % 4) * w - 1 - key % 1000",
)
ORACLES["geo_ip_overlap"] = f"""WITH {_PROBES}, {_OVERLAPPING} SELECT event_id, event_type, ip, {_GEO_IP_COLUMNS}
FROM probes LEFT JOIN overlapping r ON ip_int BETWEEN ip_from AND ip_to
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ip_to) = 1"""
_FINE = _sized_ranges("fine", "key * w + key % 1000", "key * w + key % 1000 + least(1::BIGINT << (key % 17)::INT, w // 2) - 1")
ORACLES["geo_ip_fine"] = f"""WITH {_WIDTH}, {_FINE}, fine_probes AS (
  SELECT event_id, least((event_id % n) * w + (event_id % n) % 1000
    + (event_id * 7919) % (2::BIGINT << ((event_id % n) % 17)::INT), 4294967295) AS ip FROM events, width)
SELECT event_id, ip, {_GEO_IP_COLUMNS} FROM fine_probes LEFT JOIN fine r ON ip BETWEEN ip_from AND ip_to"""
ORACLES["geo_ip_compat"] = f"""WITH {_PROBES}, {_RANGES}, next_end AS (
  SELECT event_id, ip_to FROM probes ASOF JOIN ranges ON ip_int < ip_to)
SELECT probes.event_id, event_type, ip, {_GEO_IP_COLUMNS} FROM probes
LEFT JOIN next_end USING (event_id) LEFT JOIN ranges r USING (ip_to)"""
ORACLES["geo_ip_by_country"] = f"""WITH {_PROBES}, {_RANGES} SELECT r.country_code AS geo_country_code, count(*) AS events
FROM probes LEFT JOIN ranges r ON ip_int BETWEEN ip_from AND ip_to GROUP BY 1"""
ORACLES["cidr_join"] = f"""WITH {_IPS}, sized AS (
  SELECT c_custkey, 12 + c_custkey % 13 AS len, {_HASH.format('c_custkey')} AS h FROM customer),
starts AS (SELECT c_custkey, len, h - h % (1::BIGINT << (32 - len)) AS net FROM sized),
networks AS (SELECT {_dotted('net')} || '/' || len::VARCHAR AS cidr, min(c_custkey) AS network, min(net) AS lo,
  min(net + (1::BIGINT << (32 - len)) - 1) AS hi FROM starts GROUP BY 1)
SELECT event_id, ip, cidr, network FROM ips JOIN networks ON ip BETWEEN lo AND hi"""

_PLACE_PROBES = """place_probes AS (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN upper(p_name)
    WHEN event_id % 5 = 0 THEN split_part(p_name, ' ', 1) WHEN event_id % 13 = 0 THEN 'Atlantis' ELSE p_name END AS town,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE lower(p_type) END AS area, p_brand AS brand
  FROM events JOIN part ON p_partkey = event_id % (SELECT count(*) FROM part))"""
_PLACE_ATTRIBUTES = ("accuracy", "admin_code1", "admin_code2", "admin_code3", "admin_name1", "admin_name2",
                     "admin_name3", "country_code", "place_name", "zip_code")


def _place_oracle(conditions: list[tuple[str, str]], op: str, scope: str) -> str:
    """Rows per distinct query: each condition holds when all its terms occur in the row."""
    names = [name for _, name in conditions]
    keys = ", ".join(f"coalesce(lower({n}), '~') AS q{i}" for i, n in enumerate(names))
    group = ", ".join(f"q{i}" for i in range(len(names)))
    parts = []
    for i, (column, _) in enumerate(conditions):
        bound = f"{column}:" if column else "*:"
        later = bound if scope == "column" else "*:"
        words = _words(f"q{i}")
        parts.append(
            f"SELECT {group}, {i} AS cond, CASE WHEN pos = 1 THEN '{bound}' ELSE '{later}' END || ws[pos] AS term "
            f"FROM (SELECT {group}, {words} AS ws, unnest(range(1, len({words}) + 1)) AS pos FROM asked WHERE q{i} <> '~')"
        )
    terms = "\n  UNION ".join(parts)
    given = " + ".join(f"(q{i} <> '~')::INT" for i in range(len(names)))
    if op == "AND":
        keep = f"count(*) = {given}"
    elif op == "OR":
        keep = "count(*) >= 1"
    else:
        keep = "min(cond) = first_cond AND count(*) = 1"
    first = "CASE " + " ".join(f"WHEN q{i} <> '~' THEN {i}" for i in range(len(names))) + " END"
    attributes = ", ".join(_PLACE_ATTRIBUTES)
    columns = ", ".join(f"f.{c} AS geo_{c}" for c in (*_PLACE_ATTRIBUTES, "location", "representative_point"))
    on = " AND ".join(f"q{i} = coalesce(lower({n}), '~')" for i, n in enumerate(names))
    return f"""WITH {_PLACES}, {_POSTINGS}, {_PLACE_PROBES},
asked AS (SELECT DISTINCT {keys} FROM place_probes),
terms AS ({terms}),
needed AS (SELECT {group}, cond, count(*) AS n FROM terms GROUP BY {group}, cond),
held AS (SELECT {group}, cond, row_id, count(*) AS n FROM terms JOIN postings USING (term) GROUP BY {group}, cond, row_id),
holding AS (SELECT {group}, cond, row_id, {first} AS first_cond FROM held JOIN needed USING ({group}, cond, n)),
kept AS (SELECT {group}, row_id FROM holding GROUP BY {group}, first_cond, row_id HAVING {keep}),
matches AS (SELECT {group}, {attributes}, latitude, longitude, row_id FROM kept JOIN places USING (row_id)),
{_answers('f', 'matches', group, attributes)}
SELECT event_id, town, area, brand, {columns}, NULL::VARCHAR AS geo_country_name FROM place_probes LEFT JOIN f ON {on}"""


ORACLES["place_token"] = _place_oracle([("admin_name1", "area")], "AND", "first_token")
ORACLES["place_any"] = _place_oracle([("", "town")], "AND", "first_token")
ORACLES["place_and"] = _place_oracle([("place_name", "town"), ("country_code", "brand")], "AND", "column")
ORACLES["place_or"] = _place_oracle([("place_name", "town"), ("country_code", "brand")], "OR", "column")
ORACLES["place_not"] = _place_oracle([("place_name", "town"), ("admin_name1", "area")], "NOT", "first_token")
ORACLES["geo_place"] = _place_oracle([("place_name", "town"), ("admin_name1", "area")], "AND", "first_token")

_RELAYS = f"""{_IPS}, exits AS (SELECT DISTINCT ip FROM ips WHERE event_id % 50 = 0),
servers AS (SELECT DISTINCT ip FROM ips WHERE event_id % 20 = 0),
flagged AS (SELECT event_id, ip AS ip_int, event_id % 50 IN (7, 11) AS no_ip, event_id % 50 = 9 AS bad_ip,
  CASE WHEN event_id % 50 = 7 THEN '' WHEN event_id % 50 = 9 THEN '1.2.3.x' WHEN event_id % 50 <> 11 THEN {_dotted('ip')} END AS ip,
  ip IN (SELECT ip FROM exits) AS is_exit, ip IN (SELECT ip FROM servers) AS is_server FROM ips),
tagged AS (SELECT event_id, ip,
  CASE WHEN no_ip OR bad_ip THEN 'Invalid IP' WHEN is_exit THEN 'TOR Exit Node' WHEN is_server THEN 'TOR Server' ELSE 'None' END AS tor_info,
  CASE WHEN bad_ip THEN NULL WHEN no_ip THEN FALSE ELSE is_exit END AS tor_is_exit_node,
  CASE WHEN bad_ip THEN NULL WHEN no_ip THEN FALSE ELSE is_server END AS tor_is_tor_server FROM flagged)"""
ORACLES["tor_exit"] = f"WITH {_RELAYS} SELECT event_id, tor_is_exit_node FROM tagged"
ORACLES["tor_server"] = f"WITH {_RELAYS} SELECT event_id, tor_is_tor_server FROM tagged"
ORACLES["tor_label"] = f"WITH {_RELAYS} SELECT * FROM tagged"
ORACLES["tor_missing"] = f"WITH {_RELAYS} SELECT ip AS ip_int FROM exits WHERE ip NOT IN (SELECT ip FROM servers)"

_BODY_FIELDS = [("id", "event_id::VARCHAR"), ("at", "ms::VARCHAR"), ("size", "number::VARCHAR"), ("kind", "'\"' || kind || '\"'")]


def _body(fields: list[tuple[str, str]]) -> str:
    return "'{' || concat_ws(',', " + ", ".join(f"'\"{n}\":' || {v}" for n, v in fields) + ") || '}'"


ORACLES["envelope"] = f"""WITH {_FIELDS} SELECT md5(to_json({{'id': event_id, 'kind': kind}})::VARCHAR) AS _id, 'logs' AS _index,
  'event' AS _type, {_body(_BODY_FIELDS)} AS _source FROM fields WHERE NOT too_many"""
_TEXT_FIELDS = [(n, f"'\"' || {c} || '\"'") for n, c in (("id", "event_id::VARCHAR"), ("at", "ms::VARCHAR"), ("size", "size"), ("kind", "kind"))]
ORACLES["write_docs"] = f"""WITH {_FIELDS} SELECT 'logs' AS _index, 'event' AS _type, {_body(_TEXT_FIELDS)} AS _source
FROM fields WHERE NOT too_many"""
_IDENTIFIED = """SELECT event_id, event_type, user_id, value,
  md5(to_json({'event_type': event_type, 'user_id': user_id})::VARCHAR) AS _id FROM events"""
ORACLES["dedup_last"] = f"""WITH d AS ({_IDENTIFIED})
SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY _id ORDER BY event_id DESC) = 1"""
ORACLES["upsert_merge"] = f"""WITH d AS ({_IDENTIFIED})
SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY _id ORDER BY (event_id % 3 = 0) DESC, event_id DESC) = 1"""
ORACLES["upsert_batches"] = f"""WITH d AS ({_IDENTIFIED})
SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY _id ORDER BY event_id % 3 DESC, event_id DESC) = 1"""
ORACLES["noop_count"] = f"WITH {_FIELDS} SELECT count(*) AS rows_read FROM fields WHERE NOT too_many"

_ACCESS = f"""access AS (
  SELECT event_id AS ordinal, event_id + 1700000000 AS seconds, coalesce(ip, '') AS ip, ip_int,
    'Brand#' || (event_id % 30)::VARCHAR AS brand, event_type AS kind, (event_id % 1000) / 4.0::DOUBLE AS size FROM probes)"""
ORACLES["import_by_ip"] = f"""WITH {_PROBES}, {_RANGES}, {_ACCESS},
hashed AS (SELECT event_id, {_HASH.format('event_id')} AS ip FROM events),
exits AS (SELECT DISTINCT ip FROM hashed WHERE event_id % 50 = 0),
servers AS (SELECT DISTINCT ip FROM hashed WHERE event_id % 20 = 0),
flagged AS (SELECT *, ip_int IN (SELECT ip FROM exits) AS is_exit, ip_int IN (SELECT ip FROM servers) AS is_server FROM access)
SELECT ordinal, seconds * 1000 AS at, a.ip, brand, kind, size, {_GEO_IP_COLUMNS},
  CASE WHEN ip_int IS NULL THEN 'Invalid IP' WHEN is_exit THEN 'TOR Exit Node' WHEN is_server THEN 'TOR Server' ELSE 'None' END AS tor_info,
  CASE WHEN a.ip = 'not an address' THEN NULL ELSE coalesce(is_exit, FALSE) END AS tor_is_exit_node,
  CASE WHEN a.ip = 'not an address' THEN NULL ELSE coalesce(is_server, FALSE) END AS tor_is_tor_server,
  'web' AS service,
  md5(to_json({{'ip': a.ip, 'brand': brand, 'kind': kind, 'size': size}})::VARCHAR) AS _id
FROM flagged a LEFT JOIN ranges r ON ip_int BETWEEN ip_from AND ip_to"""
_COUNTRY_BODY = [
    ("at", "'\"' || seconds::VARCHAR || '000\"'"), ("ip", "'\"' || a.ip || '\"'"), ("brand", "'\"' || brand || '\"'"),
    ("kind", "'\"' || kind || '\"'"), ("size", "'\"' || size::VARCHAR || '\"'"),
    *[(f"geo_{c}", f"'\"' || f.{c} || '\"'") for c in ("country_code", "country_name", "location", "representative_point")],
    ("service", "'\"web\"'"),
]
ORACLES["import_by_country"] = f"""WITH {_PROBES}, {_ACCESS}, {_POINTS}, {_answers('f', 'points', 'country_code', 'country_name')}
SELECT ordinal, 'access' AS _index, 'hit' AS _type, {_body(_COUNTRY_BODY)} AS _source
FROM access a LEFT JOIN f ON f.country_code = upper(brand)"""
_PLACE_GEO = ", ".join(
    f"CASE WHEN town IS NOT NULL AND area IS NOT NULL THEN geo_{c} END AS geo_{c}"
    for c in (*_PLACE_ATTRIBUTES, "location", "representative_point", "country_name")
)
ORACLES["import_by_place"] = f"""SELECT event_id AS ordinal, coalesce(town, '') AS town, coalesce(area, '') AS area, {_PLACE_GEO}
FROM ({ORACLES["geo_place"]})"""
ORACLES["import_report"] = f"""WITH {_FIELDS} SELECT event_id AS ordinal, CASE WHEN too_many THEN 'reject' ELSE 'row' END AS outcome,
  CASE WHEN too_many THEN 'too many fields' END AS reason,
  CASE WHEN NOT too_many AND (event_id % 19 = 0 OR event_id % 23 = 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0) THEN 'size' END
    AS bad_field,
  CASE WHEN NOT too_many THEN 'web' END AS service FROM fields"""
ORACLES["stream_rejects"] = f"""WITH {_FIELDS}, {_LINES} SELECT value AS line, 'too many fields' AS reason, count(*) OVER () AS failed
FROM fields JOIN lines ON ordinal = event_id WHERE too_many"""
ORACLES["stream_upsert"] = f"""WITH {_FIELDS} SELECT event_id::VARCHAR AS id, ms::VARCHAR AS at, size, kind,
  md5(to_json({{'kind': kind}})::VARCHAR) AS _id FROM fields WHERE NOT too_many AND kind IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY event_id % 2 DESC, event_id DESC) = 1"""
ORACLES["reject_collect"] = f"""WITH {_FIELDS} SELECT CASE WHEN too_many THEN 'rejects' ELSE 'rows' END AS part, count(*) AS n
FROM fields GROUP BY 1"""
ORACLES["reject_fail"] = f"""WITH {_FIELDS} SELECT event_id AS ordinal, event_id AS id, ms AS at, number AS size, kind
FROM fields WHERE event_id % 13 <> 0"""
ORACLES["place_known"] = ORACLES["geo_place"]
