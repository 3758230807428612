"""DuckDB SQL for every registered query, written independently of the Spark code.

The checker registers the parquet tables as views (lineitem, orders, part, ...). Rounded
measures use the same exact rule as ``strata.functions.exact`` so that both engines agree
on ties: decimal sums, integer-rounded means.
"""

from __future__ import annotations


def q(name: str) -> str:
    return '"' + name + '"'


def _units(col: str, scale: int) -> str:
    return f"CAST(round({col} * CAST({10 ** scale} AS DOUBLE)) AS BIGINT)"


def _half_up(total: str, k_n: str, digits: int) -> str:
    return (
        f"CAST((CASE WHEN {total} < 0 THEN -1 ELSE 1 END) * ((2 * abs({total}) + {k_n}) // (2 * ({k_n}))) AS DOUBLE)"
        f" / CAST({10 ** digits} AS DOUBLE)"
    )


def xsum(col: str, scale: int = 2, digits: int = 2) -> str:
    total = f"sum({_units(col, scale)})"
    return f"CASE WHEN {total} IS NULL THEN NULL ELSE {_half_up(total, str(10 ** (scale - digits)), digits)} END"


def xavg(col: str, scale: int = 2, digits: int = 2) -> str:
    total = f"sum({_units(col, scale)})"
    n = f"count({col})"
    return f"CASE WHEN {n} = 0 THEN NULL ELSE {_half_up(total, f'{10 ** (scale - digits)} * {n}', digits)} END"


TRIPS = """
trips AS (
  SELECT l_suppkey AS "VendorID",
         l_shipdate AS tpep_pickup_datetime,
         l_shipdate + INTERVAL 30 MINUTE AS tpep_dropoff_datetime,
         CAST(l_linenumber % 7 AS DOUBLE) AS passenger_count,
         l_quantity AS trip_distance,
         CAST(1.0 AS DOUBLE) AS "RatecodeID",
         lower(l_returnflag) AS store_and_fwd_flag,
         l_partkey AS "PULocationID",
         l_orderkey AS "DOLocationID",
         CAST(l_linenumber AS BIGINT) AS payment_type,
         l_extendedprice AS fare_amount,
         CAST(0.0 AS DOUBLE) AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax,
         CASE WHEN l_discount = 0.0 THEN NULL ELSE l_discount END AS tip_amount,
         CAST(0.0 AS DOUBLE) AS tolls_amount,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         l_extendedprice * (CAST(1.0 AS DOUBLE) + l_tax) - CAST(500.0 AS DOUBLE) AS total_amount,
         CAST(2.5 AS DOUBLE) AS congestion_surcharge,
         CAST(0.0 AS DOUBLE) AS airport_fee
  FROM lineitem)"""

TRIP_COLS = (
    '"VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, '
    '"RatecodeID", store_and_fwd_flag, "PULocationID", "DOLocationID", payment_type, fare_amount, '
    "extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, "
    "congestion_surcharge, airport_fee"
)
KEEP = (
    'tpep_pickup_datetime IS NOT NULL AND "VendorID" IS NOT NULL AND trip_distance > 0 '
    "AND passenger_count > 0 AND fare_amount >= 0 "
    "AND NOT isnan(trip_distance) AND NOT isnan(passenger_count) AND NOT isnan(fare_amount)"
)
CHECK = (
    "CASE WHEN NOT isnan(total_amount) AND NOT isnan(tip_amount) "
    "THEN total_amount >= fare_amount + tip_amount + tolls_amount + extra END"
)
CLEAN = f"""
clean AS (
  SELECT "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         "RatecodeID", upper(store_and_fwd_flag) AS store_and_fwd_flag, "PULocationID", "DOLocationID",
         payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         total_amount, congestion_surcharge, airport_fee,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
         CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
         ({CHECK}) AS total_amount_check
  FROM trips WHERE {KEEP})"""
W = f"WITH {TRIPS},{CLEAN}"

def daily(distance: int = 2, total: int = 4, other: int = 2) -> str:
    return f"""
daily AS (
  SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d') AS dia,
         count("VendorID") AS total_corridas,
         {xsum('trip_distance', distance)} AS distancia_total_km,
         {xavg('trip_distance', distance)} AS distancia_media_km,
         {xsum('total_amount', total)} AS faturamento_total,
         {xavg('total_amount', total)} AS ticket_medio,
         {xavg('tip_amount', other)} AS gorjeta_media,
         {xavg('passenger_count', other)} AS passageiros_media
  FROM clean WHERE total_amount_check = true
  GROUP BY 1)"""


def zones(distance: int = 2, total: int = 4, other: int = 2) -> str:
    return f"""
zones AS (
  SELECT "PULocationID",
         count("VendorID") AS total_corridas,
         {xsum('total_amount', total)} AS faturamento_total,
         {xavg('total_amount', total)} AS ticket_medio,
         {xavg('tip_amount', other)} AS gorjeta_media,
         {xavg('trip_distance', distance)} AS distancia_media_km,
         {xavg('passenger_count', other)} AS passageiros_media
  FROM clean WHERE total_amount_check = true
  GROUP BY 1)"""


DAILY, ZONES = daily(), zones()

ORACLE: dict[str, str] = {}

ORACLE["quality_filter"] = f"WITH {TRIPS} SELECT {TRIP_COLS} FROM trips WHERE {KEEP}"
ORACLE["valid_trips"] = f"{W} SELECT * FROM clean WHERE total_amount_check = true"
ORACLE["invalid_trips"] = f"{W} SELECT * FROM clean WHERE total_amount_check = false"
ORACLE["unclassified_trips"] = f"{W} SELECT * FROM clean WHERE total_amount_check IS NULL"
ORACLE["removed_all"] = (
    f"WITH {TRIPS} SELECT {TRIP_COLS} FROM trips WHERE NOT coalesce({KEEP}, false)"
)
ORACLE["removed_distinct"] = (
    f"WITH {TRIPS} SELECT {TRIP_COLS} FROM trips EXCEPT SELECT {TRIP_COLS} FROM trips WHERE {KEEP}"
)
ORACLE["quality_report"] = f"""{W},
removed AS (SELECT {TRIP_COLS} FROM trips EXCEPT SELECT {TRIP_COLS} FROM trips WHERE {KEEP}),
n AS (
  SELECT (SELECT count(*) FROM trips) AS total,
         (SELECT count(*) FROM clean WHERE total_amount_check = true) AS valid,
         (SELECT count(*) FROM clean WHERE total_amount_check = false) AS invalid,
         (SELECT count(*) FROM clean WHERE total_amount_check IS NULL) AS unclassified,
         (SELECT count(*) FROM trips WHERE NOT coalesce({KEEP}, false)) AS removed_n,
         (SELECT count(*) FROM removed) AS removed_distinct)
SELECT 'total' AS measure, total AS rows FROM n
UNION ALL SELECT 'valid', valid FROM n
UNION ALL SELECT 'invalid', invalid FROM n
UNION ALL SELECT 'unclassified', unclassified FROM n
UNION ALL SELECT 'removed', removed_n FROM n
UNION ALL SELECT 'removed_distinct', removed_distinct FROM n
UNION ALL SELECT 'three_table_sum', valid + invalid + removed_distinct FROM n"""
ORACLE["metrics_by_day"] = f"{W},{DAILY} SELECT * FROM daily"
ORACLE["metrics_by_zone"] = f"{W},{ZONES} SELECT * FROM zones"
ORACLE["top_days_by_revenue"] = (
    f"{W},{DAILY} SELECT * FROM daily ORDER BY faturamento_total DESC NULLS LAST, dia ASC NULLS FIRST LIMIT 5"
)
ORACLE["top_zones_by_trips"] = (
    f'{W},{ZONES} SELECT * FROM zones ORDER BY total_corridas DESC NULLS LAST, "PULocationID" ASC NULLS FIRST LIMIT 5'
)
ORACLE["top_zones_by_distance_tip"] = (
    f"{W},{ZONES} SELECT * FROM zones ORDER BY distancia_media_km DESC NULLS LAST, "
    'gorjeta_media DESC NULLS LAST, "PULocationID" ASC NULLS FIRST LIMIT 5'
)

# ---- typed contract, parts, flags, time range ----------------------------------------------

_BAD_VENDOR = "payment_type = 7"
_BAD_DIST = "store_and_fwd_flag = 'n' AND payment_type = 1"
ORACLE["apply_schema"] = f"""WITH {TRIPS}
SELECT CASE WHEN {_BAD_VENDOR} THEN NULL ELSE "VendorID" END AS "VendorID",
       tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
       CASE WHEN {_BAD_DIST} THEN NULL ELSE trip_distance END AS trip_distance,
       "RatecodeID", store_and_fwd_flag, "PULocationID", "DOLocationID", payment_type, fare_amount,
       extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
       congestion_surcharge, airport_fee
FROM trips"""
ORACLE["schema_rejects"] = f"""WITH {TRIPS},
raw AS (
  SELECT CAST("DOLocationID" AS VARCHAR) AS "DOLocationID",
         CAST(payment_type AS VARCHAR) AS payment_type,
         CASE WHEN {_BAD_VENDOR} THEN 'V' || CAST("VendorID" AS VARCHAR) ELSE CAST("VendorID" AS VARCHAR) END AS "VendorID",
         CASE WHEN {_BAD_DIST} THEN CAST(trip_distance AS VARCHAR) || ' mi' ELSE CAST(trip_distance AS VARCHAR) END AS trip_distance,
         concat_ws(',', CASE WHEN {_BAD_VENDOR} THEN 'VendorID' END,
                        CASE WHEN {_BAD_DIST} THEN 'trip_distance' END) AS rejected_columns
  FROM trips)
SELECT * FROM raw WHERE rejected_columns <> ''"""
_REJECT_RULES = {"VendorID": _BAD_VENDOR, "trip_distance": _BAD_DIST}
ORACLE["reject_counts"] = f"WITH {TRIPS} " + " UNION ALL ".join(
    f"SELECT '{c.strip(chr(34))}' AS \"column\", "
    + (f"count(*) FILTER (WHERE {_REJECT_RULES[c.strip(chr(34))]})" if c.strip(chr(34)) in _REJECT_RULES else "CAST(0 AS BIGINT)")
    + " AS rejects"
    + (" FROM trips" if c.strip(chr(34)) in _REJECT_RULES else "")
    for c in TRIP_COLS.replace(" ", "").split(",")
)
ORACLE["pickup_parts"] = f"""WITH {TRIPS}
SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
          CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
          CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day
FROM trips"""
ORACLE["normalize_flag"] = f"""WITH {TRIPS}
SELECT * REPLACE (upper(store_and_fwd_flag) AS store_and_fwd_flag) FROM trips"""
ORACLE["filter_time_range"] = (
    "SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-21 23:59:59'"
)

# ---- sales fact, keys, calendar ------------------------------------------------------------

RUN_TS = "TIMESTAMP '2024-01-01 00:00:00'"
GOLD_RUN_TS = "TIMESTAMP '2024-01-02 00:00:00'"
SILVER = f"""
silver AS (
  SELECT CAST(l_partkey AS BIGINT) AS codigo_produto, CAST(l_suppkey AS BIGINT) AS codigo_regiao,
         CAST(l_shipdate AS DATE) AS data_venda, CAST(l_quantity AS BIGINT) AS qtde_venda,
         CAST(l_extendedprice AS FLOAT) AS valor_venda, {RUN_TS} AS data_atualizacao
  FROM lineitem)"""
GOLD = f"""
gold AS (
  SELECT codigo_produto, codigo_regiao, CAST(sum(qtde_venda) AS BIGINT) AS qtde_venda,
         CAST(sum(CAST(valor_venda AS DOUBLE)) AS DOUBLE) AS valor_venda, {GOLD_RUN_TS} AS data_atualizacao,
         CAST(strftime(data_venda, '%Y%m%d') AS BIGINT) AS id_data_venda,
         TRY_CAST(CAST(codigo_produto AS VARCHAR) || CAST(codigo_regiao AS VARCHAR)
                  || strftime(data_venda, '%Y%m%d') AS BIGINT) AS id_fa_venda
  FROM silver GROUP BY codigo_produto, codigo_regiao, data_venda)"""
ORACLE["fact_rollup"] = f"""WITH {SILVER}
SELECT codigo_produto, codigo_regiao, data_venda, CAST(sum(qtde_venda) AS BIGINT) AS qtde_venda,
       CAST(sum(CAST(valor_venda AS DOUBLE)) AS DOUBLE) AS valor_venda
FROM silver GROUP BY codigo_produto, codigo_regiao, data_venda"""
ORACLE["fact_gold"] = f"WITH {SILVER},{GOLD} SELECT * FROM gold"
ORACLE["fact_key_collisions"] = f"""WITH {SILVER},{GOLD},
per AS (SELECT id_fa_venda, codigo_produto, codigo_regiao, id_data_venda, count(*) AS n
        FROM gold GROUP BY id_fa_venda, codigo_produto, codigo_regiao, id_data_venda)
SELECT id_fa_venda, count(*) AS natural_keys, CAST(sum(n) AS BIGINT) AS rows
FROM per GROUP BY id_fa_venda HAVING count(*) > 1"""
ORACLE["fact_padded_key"] = f"""WITH {SILVER},{GOLD}
SELECT codigo_produto, codigo_regiao, id_data_venda,
       lpad(CAST(codigo_produto AS VARCHAR), 10, '0') || lpad(CAST(codigo_regiao AS VARCHAR), 10, '0')
       || lpad(CAST(id_data_venda AS VARCHAR), 8, '0') AS fact_key
FROM gold"""
ORACLE["calendar_days"] = f"""
WITH b AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT CAST(day AS TIMESTAMP) AS data, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS id_data,
       CAST(strftime(day, '%d') AS BIGINT) AS dia, CAST(strftime(day, '%m') AS BIGINT) AS mes,
       CAST(strftime(day, '%Y') AS BIGINT) AS ano, CAST(strftime(day, '%m%Y') AS BIGINT) AS mesano,
       {GOLD_RUN_TS} AS dt_data_update
FROM d"""
ORACLE["generate_series"] = """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, max(ts) AS hi FROM events)
SELECT unnest(range(lo, hi, INTERVAL 1 HOUR)) AS data FROM b"""

# ---- table maintenance ---------------------------------------------------------------------


def _versions(null_keys: bool = False) -> str:
    key = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END" if null_keys else "o_orderkey"
    return f"""
o AS (SELECT {key} AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders),
t AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1998-01-01' OR o_orderdate IS NULL),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + CAST(1.0 AS DOUBLE) AS o_totalprice,
             o_orderdate, o_orderpriority FROM o WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""


_UPSERT = """
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s"""
ORACLE["upsert_update_insert"] = f"WITH {_versions()} {_UPSERT}"
ORACLE["upsert_null_key"] = f"WITH {_versions(True)} {_UPSERT}"
ORACLE["upsert_insert_only"] = f"""WITH {_versions()}
SELECT * FROM t
UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)"""
ORACLE["refresh_full"] = "SELECT * REPLACE (o_totalprice + CAST(1.0 AS DOUBLE) AS o_totalprice) FROM orders"
ORACLE["delete_all"] = "SELECT * FROM orders WHERE false"

# ---- file sources and sinks ----------------------------------------------------------------

LINES = """
lines AS (
  SELECT CASE WHEN p_size = 7 THEN substr(value, 1, 124) ELSE value END AS value FROM (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') || repeat(' ', 5)
         || rpad(substr(concat_ws(' ', upper(p_name), p_brand, p_type), 1, 101), 101, ' ')
         || strftime(DATE '2020-12-01' + p_size, '%d%m%Y')
         || (CASE WHEN p_type = 'PROMO' THEN 'L' ELSE '0' END)
         || lpad(CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR), 9, '0')
         || repeat(' ', 2) AS value, p_size
  FROM part))"""


def _price(ds: str, price_start: int) -> str:
    return f"""WITH {LINES},
f AS (
  SELECT substr(value, 1, 10) AS cd_produto, {ds} AS ds_produto,
         substr(value, 117, 2) || '-' || substr(value, 119, 2) || '-' || substr(value, 121, 4) AS atualizacao,
         substr(value, {price_start}, 10) AS preco_produto
  FROM lines),
p AS (
  SELECT *, TRY_CAST(trim(substr(preco_produto, 1, 8) || '.' || substr(preco_produto, 9, 2)) AS DECIMAL(15,2)) AS vl_preco_produto,
         CAST(try_strptime(atualizacao, '%d-%m-%Y') AS DATE) AS dt_atualizacao
  FROM f)"""


AS_READ = _price("substr(value, 16, 45)", 126)
TEN_DIGIT = _price("rtrim(substr(value, 16, 101))", 125)
ORACLE["fixed_width_as_read"] = f"{AS_READ} SELECT *, {RUN_TS} AS dt_inclusao FROM p"
ORACLE["price_bronze"] = ORACLE["fixed_width_as_read"]
ORACLE["fixed_width_ten_digit"] = f"{TEN_DIGIT} SELECT *, {RUN_TS} AS dt_inclusao FROM p"
ORACLE["fixed_width_rejects"] = f"""{TEN_DIGIT},
r AS (
  SELECT cd_produto, ds_produto, atualizacao, preco_produto,
         concat_ws(',', CASE WHEN length(preco_produto) < 10 OR trim(preco_produto) <> '' AND vl_preco_produto IS NULL THEN 'vl_preco_produto' END,
                        CASE WHEN dt_atualizacao IS NULL THEN 'dt_atualizacao' END) AS rejected_columns
  FROM p)
SELECT * FROM r WHERE rejected_columns <> ''"""

REGION_ROWS = """
region_rows AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS "CODIGO_REGIAO", s_name AS "DESCRICAO_REGIAO", n_name AS "NOME_PAIS"
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""
ORACLE["scan_csv"] = f"WITH {REGION_ROWS} SELECT * FROM region_rows"


def _dim_product(ts: str) -> str:
    return (
        "SELECT CAST(p_partkey AS BIGINT) AS codigo_produto, p_name AS descricao_produto, "
        f"p_brand AS sigla_produto, {ts} AS data_atualizacao FROM part"
    )


def _dim_region(ts: str) -> str:
    return (
        "SELECT CAST(s_suppkey AS BIGINT) AS codigo_regiao, s_name AS descricao_regiao, "
        f"n_name AS nome_pais, {ts} AS data_atualizacao FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"
    )


ORACLE["dim_product_silver"] = _dim_product(RUN_TS)
ORACLE["dim_product_gold"] = _dim_product(GOLD_RUN_TS)
ORACLE["dim_region_silver"] = _dim_region(RUN_TS)
ORACLE["dim_region_gold"] = _dim_region(GOLD_RUN_TS)
ORACLE["fact_silver"] = f"WITH {SILVER} SELECT * FROM silver"

EVENTS_TYPED = (
    "SELECT event_id, ts, user_id, event_type, value, "
    "CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props FROM events"
)
ORACLE["scan_json_pages"] = EVENTS_TYPED
ORACLE["union_pages"] = EVENTS_TYPED
ORACLE["landing_ingest"] = EVENTS_TYPED
ORACLE["overwrite_table"] = "SELECT * FROM orders"
ORACLE["lower_columns"] = "SELECT * FROM customer"
ORACLE["quality_split_valid"] = ORACLE["valid_trips"]
ORACLE["quality_split_removed"] = ORACLE["removed_all"]
ORACLE["quality_split_invalid"] = ORACLE["invalid_trips"]
ORACLE["quality_job_removed"] = ORACLE["removed_all"]
ORACLE["taxi_bronze_range"] = (
    ORACLE["apply_schema"] + " WHERE tpep_pickup_datetime BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1996-12-31 23:59:59'"
)
ORACLE["quality_split_empty_class"] = f"""WITH {TRIPS.replace("CASE WHEN l_discount = 0.0 THEN NULL ELSE l_discount END", "coalesce(l_discount, 0.0)")},{CLEAN},
removed AS (SELECT {TRIP_COLS} FROM trips WHERE NOT coalesce({KEEP}, false))
SELECT 'valid' AS measure, count(*) AS rows FROM clean WHERE total_amount_check
UNION ALL SELECT 'invalid', count(*) FROM clean WHERE NOT total_amount_check
UNION ALL SELECT 'unclassified', count(*) FROM clean WHERE total_amount_check IS NULL
UNION ALL SELECT 'removed', count(*) FROM removed
UNION ALL SELECT 'removed_distinct', count(*) FROM (SELECT DISTINCT * FROM removed)"""
ORACLE["fact_gold_partitioned_upsert"] = f"""
WITH silver AS (
  SELECT CAST(l_partkey AS BIGINT) AS codigo_produto, CAST(l_suppkey AS BIGINT) AS codigo_regiao, CAST(l_shipdate AS DATE) AS data_venda,
         CAST(CASE WHEN l_shipdate >= TIMESTAMP '1998-07-01' THEN l_quantity * 2 ELSE l_quantity END AS BIGINT) AS qtde_venda,
         CAST(l_extendedprice AS FLOAT) AS valor_venda
  FROM lineitem)
SELECT codigo_produto, codigo_regiao, CAST(sum(qtde_venda) AS BIGINT) AS qtde_venda,
       CAST(sum(CAST(valor_venda AS DOUBLE)) AS DOUBLE) AS valor_venda,
       CASE WHEN data_venda >= DATE '1998-07-01' THEN {GOLD_RUN_TS} ELSE {RUN_TS} END AS data_atualizacao,
       CAST(strftime(data_venda, '%Y%m%d') AS BIGINT) AS id_data_venda,
       TRY_CAST(CAST(codigo_produto AS VARCHAR) || CAST(codigo_regiao AS VARCHAR)
                || strftime(data_venda, '%Y%m%d') AS BIGINT) AS id_fa_venda,
       coalesce(CAST(strftime(data_venda, '%Y%m') AS BIGINT), 0) AS mes_venda, coalesce(data_venda >= DATE '1998-01-01', false) AS recente
FROM silver GROUP BY codigo_produto, codigo_regiao, data_venda"""

for _name in ("overwrite_managed_table", "refresh_table", "delete_then_insert_table"):
    ORACLE[_name] = "SELECT * FROM orders"
ORACLE["upsert_table"] = ORACLE["upsert_update_insert"]
ORACLE["insert_new_table"] = ORACLE["upsert_insert_only"]
ORACLE["scan_table_columns"] = "SELECT c_custkey, c_name FROM customer"
ORACLE["scan_path"] = "SELECT * FROM supplier"
ORACLE["register_csv"] = ORACLE["scan_csv"]
ORACLE["json_rejects"] = """SELECT '{"event_id":"' || event_id || '"' AS corrupt_line FROM events WHERE event_type = 'error'"""
ORACLE["fact_text_key"] = f"""WITH {SILVER},{GOLD}
SELECT codigo_produto, codigo_regiao, id_data_venda,
       CAST(codigo_produto AS VARCHAR) || CAST(codigo_regiao AS VARCHAR) || CAST(id_data_venda AS VARCHAR) AS fact_key
FROM gold"""

# ---- inputs that exercise the operators: three decimals, NaN, equal rows, repeated keys ------------


def _mills(with_nan: bool) -> str:
    """The trips with other measures; exact in binary, so plain sums do not depend on the order."""
    nan = lambda line, x: f"CASE WHEN payment_type = {line} THEN 'NaN'::DOUBLE ELSE {x} END" if with_nan else x
    renamed = TRIPS.replace("trips AS (", "all_trips AS (")
    return f"""{renamed},
trips AS (SELECT * REPLACE ({nan(3, 'trip_distance / 8')} AS trip_distance, trip_distance * 2 AS fare_amount,
  CASE WHEN payment_type % 2 = 0 THEN 0.25::DOUBLE ELSE 1.5::DOUBLE END AS tip_amount,
  {nan(4, 'trip_distance * 4')} AS total_amount) FROM all_trips)"""


_REPEATED = TRIPS.replace("trips AS (", "all_trips AS (") + """,
trips AS (SELECT * REPLACE (CASE WHEN payment_type = 6 THEN NULL ELSE "VendorID" % 3 END AS "VendorID",
  TIMESTAMP '2023-01-01 00:00:00' AS tpep_pickup_datetime, TIMESTAMP '2023-01-01 00:00:00' AS tpep_dropoff_datetime,
  2.0::DOUBLE AS trip_distance, "PULocationID" % 5 AS "PULocationID", 0::BIGINT AS "DOLocationID", 10.0::DOUBLE AS fare_amount,
  1.0::DOUBLE AS tip_amount, 12.0::DOUBLE AS total_amount) FROM all_trips)"""
# read in millionths, which holds every value whole
ORACLE["metrics_by_day_mills"] = f"WITH {_mills(True)},{CLEAN},{daily(6, 6, 6)} SELECT * FROM daily"
ORACLE["metrics_by_zone_plain"] = f"WITH {_mills(False)},{CLEAN},{zones(6, 6, 6)} SELECT * FROM zones"
ORACLE["quality_report_nan"] = ORACLE["quality_report"].replace(TRIPS, _mills(True))
ORACLE["quality_report_repeated"] = ORACLE["quality_report"].replace(TRIPS, _REPEATED)
ORACLE["removed_distinct_repeated"] = ORACLE["removed_distinct"].replace(TRIPS, _REPEATED)
ORACLE["fact_rollup_by_region"] = f"""WITH {SILVER}
SELECT codigo_regiao, CAST(sum(qtde_venda) AS BIGINT) AS qtde_venda, CAST(sum(CAST(valor_venda AS DOUBLE)) AS DOUBLE) AS valor_venda
FROM silver GROUP BY codigo_regiao"""
ORACLE["fact_hash_key"] = f"WITH {SILVER},{GOLD} SELECT count(*) AS facts, count(*) AS fact_keys FROM gold"
ORACLE["upsert_repeated_target"] = f"""WITH {_versions()},
tt AS (SELECT * FROM t UNION ALL SELECT * FROM t)
SELECT * FROM tt WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = tt.o_orderkey)
UNION ALL SELECT s.* FROM s JOIN tt USING (o_orderkey)
UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)"""

# ---- landing, jobs run more than once, merges of several writers ---------------------------------

ORACLE["union_page_frames"] = EVENTS_TYPED
ORACLE["landing_broken_lines"] = ORACLE["json_rejects"]
ORACLE["landing_unique_rows"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
ORACLE["landing_time_range"] = EVENTS_TYPED + " WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-21 23:59:59'"
ORACLE["taxi_broken_lines"] = """SELECT '{"DOLocationID":"' || l_orderkey || '","Ven' AS corrupt_line FROM lineitem WHERE l_linenumber = 7"""
ORACLE["dim_product_silver_job"] = f"""
SELECT CAST(p_partkey AS BIGINT) AS codigo_produto, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS descricao_produto,
       p_brand AS sigla_produto, CASE WHEN p_partkey % 2 = 0 THEN {GOLD_RUN_TS} ELSE {RUN_TS} END AS data_atualizacao FROM part"""
ORACLE["taxi_gold_loads_by_day"] = ORACLE["metrics_by_day"]
ORACLE["taxi_gold_loads_by_zone"] = ORACLE["metrics_by_zone"]
_REPORT = "SELECT '{0}' AS report, CAST({1} AS VARCHAR) AS \"of\", total_corridas, faturamento_total FROM ({2})"
ORACLE["taxi_gold_reports"] = " UNION ALL ".join(
    _REPORT.format(name, key, ORACLE[name])
    for name, key in (("top_days_by_revenue", "dia"), ("top_zones_by_trips", '"PULocationID"'), ("top_zones_by_distance_tip", '"PULocationID"'))
)
ORACLE["upsert_two_writers"] = ORACLE["upsert_update_insert"]
ORACLE["upsert_bucketed_table"] = ORACLE["upsert_update_insert"]
ORACLE["upsert_heavy_key"] = f"""WITH {_versions()},
hot AS (SELECT 0::BIGINT AS o_orderkey, min(o_custkey) AS o_custkey, 'Z' AS o_orderstatus, 0.0::DOUBLE AS o_totalprice,
               min(o_orderdate) AS o_orderdate, 'HOT' AS o_orderpriority FROM s),
s2 AS (SELECT * FROM s WHERE o_orderkey % 3 <> 0)
SELECT * FROM t WHERE o_orderkey % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM s2 WHERE s2.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s2
UNION ALL SELECT hot.* FROM hot, t WHERE t.o_orderkey % 3 = 0"""
ORACLE["overwrite_default_format"] = "SELECT * FROM orders"
ORACLE["hash_key_null_parts"] = """
SELECT count(*) AS keys, count(*) AS combinations FROM (
  SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_custkey END AS a, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS b,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS c FROM orders)"""
ORACLE["typed_split_good"] = ORACLE["apply_schema"] + f" WHERE NOT ({_BAD_VENDOR}) AND NOT ({_BAD_DIST})"
ORACLE["typed_split_rejects"] = f"""WITH {TRIPS}
SELECT "DOLocationID", payment_type,
       CASE WHEN {_BAD_VENDOR} THEN 'V' || CAST("VendorID" AS VARCHAR) WHEN payment_type = 2 THEN CAST("VendorID" AS VARCHAR) || '.0'
            ELSE CAST("VendorID" AS VARCHAR) END AS vendor_text,
       CASE WHEN {_BAD_DIST} THEN CAST(trip_distance AS VARCHAR) || ' mi' ELSE CAST(trip_distance AS VARCHAR) END AS distance_text,
       concat_ws(',', CASE WHEN {_BAD_VENDOR} THEN 'VendorID' END, CASE WHEN {_BAD_DIST} THEN 'trip_distance' END) AS rejected_columns
FROM trips WHERE {_BAD_VENDOR} OR ({_BAD_DIST})"""
ORACLE["metrics_by_zone_order_free"] = ORACLE["metrics_by_zone_plain"]
ORACLE["distinct_estimates"] = """
SELECT event_type, count(DISTINCT user_id) AS users_exact, true AS within_2_percent FROM events GROUP BY event_type"""
ORACLE["dim_region_gold_job"] = ORACLE["dim_region_gold"]
ORACLE["fact_jobs"] = ORACLE["fact_gold"]
ORACLE["calendar_job"] = f"""
WITH y AS (SELECT year(min(o_orderdate)) AS lo, year(max(o_orderdate)) AS hi FROM orders),
d AS (SELECT unnest(range(make_date(lo, 1, 1)::TIMESTAMP, make_date(hi + 1, 1, 1)::TIMESTAMP, INTERVAL 1 DAY)) AS data, lo FROM y)
SELECT data, CAST(strftime(data, '%Y%m%d') AS BIGINT) AS id_data, day(data) AS dia, month(data) AS mes, year(data) AS ano,
       CAST(strftime(data, '%m%Y') AS BIGINT) AS mesano, CASE WHEN year(data) = lo THEN {RUN_TS} ELSE {GOLD_RUN_TS} END AS dt_data_update
FROM d"""
ORACLE["taxi_silver_job"] = ORACLE["apply_schema"]
ORACLE["load_stamp"] = "SELECT count(*) AS rows, count(*) AS of_this_run, 1::BIGINT AS stamps FROM orders"
