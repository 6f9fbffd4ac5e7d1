"""DuckDB SQL equivalents of the named queries (tables pre-registered as views)."""

from __future__ import annotations

from lodestar.functions.hashing import portable_bucket_sql, portable_row_id_sql

LINE_ID = portable_row_id_sql("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

ORACLE: dict[str, str] = {}


def _xmean(col: str, scale: int = 2) -> str:
    """Mean from an exact decimal sum (identical double in every engine)."""
    return f"(CAST(SUM(CAST({col} AS DECIMAL(38,{scale}))) AS DOUBLE) / COUNT({col}))"


def _fr(x: str, digits: int = 6) -> str:
    """Half-up rounding written as IEEE arithmetic (same bits in Spark and here)."""
    m = f"{10.0 ** digits!r}::DOUBLE"
    return f"(floor(({x}) * {m} + 0.5::DOUBLE) / {m})"



def _b(key: str, seed, modulus: int = 1000) -> str:
    """Portable bucket; ``seed`` may be an int or a SQL expression."""
    s = f"'{seed}'" if isinstance(seed, int) else f"CAST({seed} AS VARCHAR)"
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '-' || {s}), 1, 8))::BIGINT % {modulus})"


def _part(thousandths: int) -> int:
    """The 32-bit hash below which so many thousandths of all hashes lie."""
    return int(thousandths / 1000 * 4294967296 + 0.5)


# Analogue taxi source, same projection as fixtures.taxi_trips.
TAXI_RAW = f"""
  SELECT {LINE_ID} AS row_id, l_orderkey AS trip_id, CAST(l_linenumber AS BIGINT) AS leg,
         l_extendedprice AS fare_amount, CAST(nullif(l_linenumber, 3) AS BIGINT) AS passenger_count,
         l_quantity AS trip_distance, l_returnflag AS rate_code_id, l_discount AS tip_rate,
         l_tax AS tax_rate, l_shipdate AS pickup_datetime,
         -75.0 + (l_suppkey % 200) / 100 AS pickup_longitude,
         40.0 + (l_partkey % 200) / 100 AS pickup_latitude,
         -75.0 + (l_orderkey % 200) / 100 AS dropoff_longitude,
         40.5 + (l_partkey % 200) / 100 AS dropoff_latitude
  FROM lineitem"""


def _clean_taxi(raw: str) -> str:
    return f"""
  SELECT * FROM (SELECT row_id, trip_id,
         COALESCE(TRY_CAST(leg AS INTEGER), -1) AS leg,
         COALESCE(CAST(fare_amount AS FLOAT), -1) AS fare_amount,
         COALESCE(TRY_CAST(passenger_count AS INTEGER), -1) AS passenger_count,
         COALESCE(CAST(trip_distance AS FLOAT), -1) AS trip_distance,
         COALESCE(TRY_CAST(COALESCE(rate_code_id, '-1') AS FLOAT), -1) AS rate_code_id,
         COALESCE(CAST(tip_rate AS FLOAT), -1) AS tip_rate,
         COALESCE(CAST(tax_rate AS FLOAT), -1) AS tax_rate,
         pickup_datetime,
         COALESCE(CAST(pickup_longitude AS FLOAT), -1) AS pickup_longitude,
         COALESCE(CAST(pickup_latitude AS FLOAT), -1) AS pickup_latitude,
         COALESCE(CAST(dropoff_longitude AS FLOAT), -1) AS dropoff_longitude,
         COALESCE(CAST(dropoff_latitude AS FLOAT), -1) AS dropoff_latitude
  FROM ({raw}) raw
  WHERE fare_amount > 1000 AND fare_amount < 100000
    AND passenger_count > 0 AND passenger_count < 6
    AND pickup_longitude > -75 AND pickup_longitude < -73
    AND dropoff_longitude > -75 AND dropoff_longitude < -73
    AND pickup_latitude > 40 AND pickup_latitude < 42
    AND dropoff_latitude > 40 AND dropoff_latitude < 42) cleaned
  WHERE fare_amount > 1000 AND fare_amount < 100000
    AND passenger_count > 0 AND passenger_count < 6
    AND pickup_longitude > -75 AND pickup_longitude < -73
    AND dropoff_longitude > -75 AND dropoff_longitude < -73
    AND pickup_latitude > 40 AND pickup_latitude < 42
    AND dropoff_latitude > 40 AND dropoff_latitude < 42"""


CLEAN_TAXI = _clean_taxi(TAXI_RAW)

ORACLE["clean_taxi"] = CLEAN_TAXI

ORACLE["clean_wide_keys"] = _clean_taxi(TAXI_RAW.replace("l_orderkey AS trip_id", "l_orderkey + 3000000000 AS trip_id"))

ORACLE["row_counts"] = f"""
  SELECT (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS rows_loaded,
         (SELECT CAST(count(*) AS BIGINT) FROM ({CLEAN_TAXI}) c) AS rows_clean"""

ORACLE["taxi_fare_weekday"] = f"""
  SELECT split, day_of_week, is_weekend, COUNT(*) AS n_trips,
         {_fr(_xmean('fare_amount'), 4)} AS mean_fare, round(stddev_samp(fare_amount), 4) AS std_fare,
         {_fr(_xmean('trip_distance'))} AS mean_distance
  FROM (SELECT *, isodow(pickup_datetime) - 1 AS day_of_week,
               CAST(isodow(pickup_datetime) >= 6 AS INTEGER) AS is_weekend,
               CASE WHEN {_b('trip_id', 42, 4294967296)} < {_part(800)} THEN 'train' ELSE 'test' END AS split
        FROM ({CLEAN_TAXI}) c) t
  GROUP BY split, day_of_week, is_weekend"""


def _money(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


# ----------------------------------------------------------------- sampling / splitting
ORACLE["hash_sample"] = f"""
  SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {_b('o_orderkey', 7, 4294967296)} < {_part(800)}"""

ORACLE["fixed_count_sample"] = f"""
  SELECT o_orderkey, o_totalprice FROM orders
  ORDER BY {_b('o_orderkey', 0, 4294967296)}, o_orderkey LIMIT 1000"""

ORACLE["split_counts"] = f"""
  SELECT seed, split, COUNT(*) AS n, {_money('o_totalprice')} AS total_price
  FROM (SELECT o_totalprice, seed,
               CASE WHEN {_b('o_orderkey', 'seed', 4294967296)} < {_part(800)} THEN 'train' ELSE 'test' END AS split
        FROM orders, (VALUES (0), (1), (2), (3), (4)) s(seed)) t
  GROUP BY seed, split"""

ORACLE["kfold_counts"] = f"""
  SELECT CAST({_b('o_orderkey', 0, 5)} AS INTEGER) AS fold, COUNT(*) AS n, {_money('o_totalprice')} AS total_price
  FROM orders GROUP BY 1"""

ORACLE["row_estimate"] = f"""
  WITH per AS (
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS source, COUNT(*) FILTER (hit) AS sampled,
           CAST(round(COUNT(*) FILTER (hit) / 0.1) AS BIGINT) AS estimate
    FROM (SELECT o_orderdate, {_b('o_orderkey', 3, 4294967296)} < {_part(100)} AS hit FROM orders) o GROUP BY 1)
  SELECT * FROM per
  UNION ALL SELECT NULL, CAST(SUM(sampled) AS BIGINT), CAST(SUM(estimate) AS BIGINT) FROM per"""

ORACLE["ordered_split"] = """
  SELECT split, COUNT(*) AS n, MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key
  FROM (SELECT o_orderkey,
               CASE WHEN row_number() OVER (ORDER BY o_orderkey)
                         <= (SELECT COUNT(*) - ceil(COUNT(*) * 0.2) FROM orders) THEN 'train' ELSE 'test' END AS split
        FROM orders) t
  GROUP BY split"""

ORACLE["train_infer_split"] = f"""
  SELECT 'train' AS part, COUNT(*) AS n FROM orders WHERE {_b('o_orderkey', 5, 4294967296)} < {_part(750)}
  UNION ALL SELECT 'infer', COUNT(*) FROM orders WHERE {_b('o_orderkey', 5, 4294967296)} >= {_part(750)}
  UNION ALL SELECT 'infer_overlapping', COUNT(*) FROM orders WHERE {_b('o_orderkey', 5, 4294967296)} < {_part(250)}"""

# ----------------------------------------------------------------- date / geo
ORACLE["date_features"] = """
  SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(year(ts) AS INTEGER) AS year,
         CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
         CAST((dayofweek(ts) + 1) % 7 AS INTEGER) AS dow_sat0, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
         CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend
  FROM events"""

ORACLE["weekend_flag"] = """
  SELECT CAST((dayofweek(l_shipdate) + 1) % 7 AS INTEGER) AS dow_sat0,
         CAST(isodow(l_shipdate) >= 6 AS INTEGER) AS is_weekend, COUNT(*) AS n
  FROM lineitem GROUP BY 1, 2"""

ORACLE["duration_seconds"] = """
  SELECT l_orderkey, l_linenumber, date_diff('second', o_orderdate, l_shipdate) AS duration_s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

GEO_RAW = """
  SELECT l_orderkey AS trip_id, CAST(l_linenumber AS BIGINT) AS leg,
         40.0::DOUBLE + (l_partkey % 200) / 100 AS pickup_latitude,
         -75.0::DOUBLE + (l_suppkey % 200) / 100 AS pickup_longitude,
         40.5::DOUBLE + (l_partkey % 200) / 100 AS dropoff_latitude,
         -75.0::DOUBLE + (l_orderkey % 200) / 100 AS dropoff_longitude
  FROM lineitem"""


def _round01(x: str) -> str:
    return f"(floor({x} / 0.01::DOUBLE) * 0.01::DOUBLE)"


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"(12742.0::DOUBLE * asin(least(1.0::DOUBLE, sqrt({a}))))"


ORACLE["geo_round"] = f"""
  SELECT trip_id, leg,
         round({_round01('pickup_latitude')}, 6) AS pickup_latitude_r,
         round({_round01('pickup_longitude')}, 6) AS pickup_longitude_r,
         round({_round01('dropoff_latitude')}, 6) AS dropoff_latitude_r,
         round({_round01('dropoff_longitude')}, 6) AS dropoff_longitude_r
  FROM ({GEO_RAW}) g"""

ORACLE["haversine_km"] = f"""
  SELECT trip_id, leg,
         round({_hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude')}, 6) AS h_distance,
         round({_hav(_round01('pickup_latitude'), _round01('pickup_longitude'),
                     _round01('dropoff_latitude'), _round01('dropoff_longitude'))}, 6) AS h_distance_rounded
  FROM ({GEO_RAW}) g"""

ORACLE["taxi_features"] = f"""
  SELECT trip_id, leg, CAST(hour(pickup_datetime) AS INTEGER) AS hour, CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month, CAST(day(pickup_datetime) AS INTEGER) AS day,
         CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS day_of_week,
         CAST(isodow(pickup_datetime) >= 6 AS INTEGER) AS is_weekend,
         CAST({_hav('CAST(pickup_latitude AS DOUBLE)', 'CAST(pickup_longitude AS DOUBLE)',
                    'CAST(dropoff_latitude AS DOUBLE)', 'CAST(dropoff_longitude AS DOUBLE)')} AS FLOAT) AS h_distance
  FROM ({CLEAN_TAXI}) c"""

# ----------------------------------------------------------------- encoders
ORACLE["label_encode"] = f"""
  WITH train AS (SELECT * FROM part WHERE {_b('p_partkey', 1, 4294967296)} < {_part(700)}),
       test AS (SELECT * FROM part WHERE {_b('p_partkey', 1, 4294967296)} >= {_part(700)}),
       db AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code
              FROM (SELECT DISTINCT p_brand FROM train WHERE p_brand IS NOT NULL) x),
       dt AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code
              FROM (SELECT DISTINCT p_type FROM train WHERE p_type IS NOT NULL) x)
  SELECT t.p_partkey,
         CAST(CASE WHEN t.p_brand IS NULL THEN -1 ELSE COALESCE(db.code, (SELECT COUNT(*) FROM db)) END AS INTEGER) AS p_brand_code,
         CAST(CASE WHEN t.p_type IS NULL THEN -1 ELSE COALESCE(dt.code, (SELECT COUNT(*) FROM dt)) END AS INTEGER) AS p_type_code
  FROM test t LEFT JOIN db ON t.p_brand = db.p_brand LEFT JOIN dt ON t.p_type = dt.p_type"""

ORACLE["category_codes"] = """
  WITH o AS (SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders),
       dp AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
              FROM (SELECT DISTINCT o_orderpriority FROM o WHERE o_orderpriority IS NOT NULL) x),
       ds AS (SELECT o_orderstatus, CAST(row_number() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS code
              FROM (SELECT DISTINCT o_orderstatus FROM o WHERE o_orderstatus IS NOT NULL) x)
  SELECT o.o_orderkey,
         CAST(CASE WHEN o.o_orderpriority IS NULL THEN -1 ELSE COALESCE(dp.code, (SELECT COUNT(*) FROM dp)) END AS INTEGER) AS o_orderpriority_code,
         CAST(CASE WHEN o.o_orderstatus IS NULL THEN -1 ELSE COALESCE(ds.code, (SELECT COUNT(*) FROM ds)) END AS INTEGER) AS o_orderstatus_code
  FROM o LEFT JOIN dp ON o.o_orderpriority = dp.o_orderpriority LEFT JOIN ds ON o.o_orderstatus = ds.o_orderstatus"""

ORACLE["target_encode_oof"] = """
  WITH d AS (SELECT o_orderkey, o_orderpriority, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
                    CAST(o_orderkey % 5 AS INTEGER) AS fold FROM orders),
       cf AS (SELECT o_orderpriority, fold, SUM(CAST(y AS DOUBLE)) AS s_cf, COUNT(y) AS n_cf FROM d GROUP BY 1, 2),
       c AS (SELECT o_orderpriority, SUM(s_cf) AS s_c, SUM(n_cf) AS n_c FROM cf GROUP BY 1),
       m AS (SELECT AVG(CAST(y AS DOUBLE)) AS mu FROM d)
  SELECT d.o_orderkey, d.fold,
         round((c.s_c - cf.s_cf + 0.001::DOUBLE * m.mu) / (CAST(c.n_c - cf.n_cf AS DOUBLE) + 0.001::DOUBLE), 6) AS te
  FROM d JOIN cf ON d.o_orderpriority = cf.o_orderpriority AND d.fold = cf.fold
         JOIN c ON d.o_orderpriority = c.o_orderpriority CROSS JOIN m"""

ORACLE["target_encode_apply"] = f"""
  WITH d AS (SELECT o_orderkey, o_custkey % 97 AS cust_bucket, CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders),
       train AS (SELECT * FROM d WHERE {_b('o_orderkey', 2, 4294967296)} < {_part(800)}),
       test AS (SELECT * FROM d WHERE {_b('o_orderkey', 2, 4294967296)} >= {_part(800)}),
       c AS (SELECT cust_bucket, SUM(CAST(y AS DOUBLE)) AS s_c, COUNT(y) AS n_c FROM train GROUP BY 1),
       m AS (SELECT AVG(CAST(y AS DOUBLE)) AS mu FROM train)
  SELECT t.o_orderkey,
         round(CASE WHEN c.n_c IS NULL THEN m.mu
                    ELSE (c.s_c + 0.001::DOUBLE * m.mu) / (CAST(c.n_c AS DOUBLE) + 0.001::DOUBLE) END, 6) AS te
  FROM test t LEFT JOIN c ON t.cust_bucket = c.cust_bucket CROSS JOIN m"""

# ----------------------------------------------------------------- feature generation / selection
_PAIR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber_f"]


def _pairwise_sql() -> str:
    import itertools
    exprs = [f"round({a} + {b}, 6) AS {a}_{b}_plus" for a, b in itertools.combinations(_PAIR_COLS, 2)]
    return (f"SELECT l_orderkey, l_linenumber, {', '.join(exprs)} FROM "
            f"(SELECT *, CAST(l_linenumber AS DOUBLE) AS l_linenumber_f FROM lineitem) x")


ORACLE["pairwise_sums"] = _pairwise_sql()

ORACLE["chi2_scores"] = """
  WITH pc AS (SELECT l_returnflag, COUNT(*) AS n,
                     CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
                     CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS l_discount,
                     CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS l_tax,
                     CAST(SUM(CAST(l_linenumber AS DECIMAL(18,2))) AS DOUBLE) AS l_linenumber
              FROM lineitem GROUP BY 1),
       lg AS (UNPIVOT pc ON l_quantity, l_discount, l_tax, l_linenumber INTO NAME feature VALUE observed),
       x AS (SELECT *, n / SUM(n) OVER (PARTITION BY feature) AS p, SUM(observed) OVER (PARTITION BY feature) AS tot
             FROM lg),
       s AS (SELECT feature, SUM(pow(observed - p * tot, 2) / (p * tot)) AS chi2 FROM x GROUP BY feature)
  SELECT feature, round(chi2, 6) AS chi2, CAST(row_number() OVER (ORDER BY chi2 DESC, feature) AS INTEGER) AS rank
  FROM s"""


# ----------------------------------------------------------------- aggregates
TIMING = """
  SELECT event_id, event_type AS type, CAST(user_id % 4 + 1 AS INTEGER) AS n_workers,
         CASE WHEN hour(ts) < 12 THEN 'cpu' ELSE 'gpu' END AS hardware, value AS elapsed_ms
  FROM events"""

TRIAL_LOG = """
  SELECT user_id AS trial, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step
  FROM events"""

RUNNING_MEAN = f"""
  SELECT trial, step, value,
         round(SUM(value) OVER w / COUNT(value) OVER w, 9) AS rm
  FROM ({TRIAL_LOG}) l
  WINDOW w AS (PARTITION BY trial ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ORACLE["tip_ratio_by_size"] = """
  SELECT CAST(l_quantity AS INTEGER) AS size,
         round(AVG(l_extendedprice * l_tax / l_extendedprice * 100.0::DOUBLE), 6) AS mean_tip_percentage
  FROM lineitem GROUP BY 1"""

ORACLE["elapsed_ci"] = f"""
  SELECT type, n_workers, hardware, n, {_fr('mean')} AS mean, round(std, 6) AS std,
         round(1.96::DOUBLE * std / sqrt(n), 6) AS ci,
         round(mean - 1.96::DOUBLE * std / sqrt(n), 6) AS ci_low,
         round(mean + 1.96::DOUBLE * std / sqrt(n), 6) AS ci_high
  FROM (SELECT type, n_workers, hardware, {_xmean('elapsed_ms')} * 0.001::DOUBLE AS mean,
               stddev_samp(elapsed_ms * 0.001::DOUBLE) AS std, COUNT(elapsed_ms) AS n
        FROM ({TIMING}) t GROUP BY 1, 2, 3) g"""

ORACLE["box_stats"] = f"""
  SELECT type, n_workers, COUNT(elapsed_ms) AS n,
         round(quantile_cont(elapsed_ms, 0.25), 6) AS q1, round(quantile_cont(elapsed_ms, 0.5), 6) AS median,
         round(quantile_cont(elapsed_ms, 0.75), 6) AS q3,
         round(quantile_cont(elapsed_ms, 0.75) - quantile_cont(elapsed_ms, 0.25), 6) AS iqr,
         round(MIN(elapsed_ms), 6) AS min, round(MAX(elapsed_ms), 6) AS max
  FROM ({TIMING}) t GROUP BY 1, 2"""

ORACLE["throughput_ratio"] = f"""
  WITH g AS (SELECT type, COUNT(*) AS rows, CAST(SUM(CAST(elapsed_ms AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS elapsed_s
             FROM ({TIMING}) t GROUP BY 1)
  SELECT type, rows, elapsed_s, round(rows / elapsed_s, 6) AS rows_per_s,
         round((rows / elapsed_s) / MAX(CASE WHEN type = 'view' THEN rows / elapsed_s END) OVER (), 6) AS speedup
  FROM g"""

ORACLE["best_so_far"] = f"""
  SELECT step, {_fr(_xmean('best'))} AS mean_best, COUNT(best) AS n_runs
  FROM (SELECT row_number() OVER w AS step, MAX(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) c
  GROUP BY step"""

ORACLE["replicate_band"] = f"""
  SELECT step, {_fr('mean')} AS mean, round(std, 6) AS std, round(mx, 6) AS max, round(mn, 6) AS min,
         round(least(mean + std, mx), 6) AS upper, round(greatest(mean - std, mn), 6) AS lower
  FROM (SELECT step, {_xmean('value')} AS mean, stddev_samp(value) AS std, MAX(value) AS mx, MIN(value) AS mn
        FROM ({TRIAL_LOG}) l GROUP BY step) g"""

ORACLE["union_years"] = """
  SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN year(l_shipdate) % 3 = 1 THEN l_discount END AS l_discount,
         CASE WHEN year(l_shipdate) % 3 = 2 THEN l_tax END AS l_tax
  FROM lineitem WHERE l_shipdate IS NOT NULL"""

ORACLE["score_heatmap"] = f"""
  SELECT l_linenumber,
         {_fr(_xmean("CASE WHEN l_returnflag = 'A' THEN l_discount END"))} AS "A",
         {_fr(_xmean("CASE WHEN l_returnflag = 'N' THEN l_discount END"))} AS "N",
         {_fr(_xmean("CASE WHEN l_returnflag = 'R' THEN l_discount END"))} AS "R"
  FROM lineitem GROUP BY 1"""

ORACLE["preview_head"] = """
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5"""

# ----------------------------------------------------------------- metrics
DOC_PRED = """
  SELECT l.doc_id, l.quality, d.n_chars,
         1.0::DOUBLE / (1.0::DOUBLE + exp(-(CAST(d.n_chars AS DOUBLE) - 1500.0::DOUBLE) / 500.0::DOUBLE)) AS prob,
         CAST(d.n_chars >= 1500 AS INTEGER) AS pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""

ORACLE["accuracy"] = f"""
  SELECT COUNT(*) AS n, {_fr("AVG(CAST(CAST(quality AS DOUBLE) = CAST(pred AS DOUBLE) AS INTEGER))")} AS accuracy,
         round(1.0::DOUBLE - AVG(CAST(CAST(quality AS DOUBLE) = CAST(pred AS DOUBLE) AS INTEGER)), 6) AS error_rate
  FROM ({DOC_PRED}) p"""

ORACLE["auc_rank"] = f"""
  WITH h AS (SELECT n_chars, SUM(CAST(quality AS BIGINT)) AS pos, COUNT(*) AS cnt FROM ({DOC_PRED}) p GROUP BY 1),
       c AS (SELECT *, SUM(cnt) OVER (ORDER BY n_chars ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM h),
       t AS (SELECT SUM(pos * (cum - cnt + (cnt + 1) / 2.0::DOUBLE)) AS rsum, CAST(SUM(pos) AS BIGINT) AS n_pos,
                    CAST(SUM(cnt - pos) AS BIGINT) AS n_neg FROM c)
  SELECT n_pos, n_neg,
         round((rsum - n_pos * (n_pos + 1) / 2.0::DOUBLE) / (CAST(n_pos AS DOUBLE) * CAST(n_neg AS DOUBLE)), 6) AS auc
  FROM t"""

ORACLE["logloss"] = f"""
  SELECT COUNT(*) AS n,
         round(AVG(-(CAST(quality AS DOUBLE) * ln(least(greatest(prob, 1e-15), 1 - 1e-15))
                   + (1.0::DOUBLE - CAST(quality AS DOUBLE)) * ln(1.0::DOUBLE - least(greatest(prob, 1e-15), 1 - 1e-15)))), 6)
           AS log_loss
  FROM ({DOC_PRED}) p"""

PRICE_PRED = """
  SELECT l_extendedprice / 1000 AS y, l_quantity * 1.5::DOUBLE * (1.0::DOUBLE - l_discount) AS pred FROM lineitem"""

ORACLE["rmse"] = f"""
  SELECT COUNT(*) AS n, round(AVG((y - pred) * (y - pred)), 6) AS mse,
         round(sqrt(AVG((y - pred) * (y - pred))), 6) AS rmse, round(AVG(abs(y - pred)), 6) AS mae
  FROM ({PRICE_PRED}) p"""

ORACLE["r2"] = f"""
  SELECT COUNT(*) AS n, round(1.0::DOUBLE - SUM((y - pred) * (y - pred)) / (COUNT(*) * var_pop(y)), 6) AS r2
  FROM ({PRICE_PRED}) p"""

ORACLE["purity"] = """
  WITH c AS (SELECT CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS cluster, label
             FROM embeddings),
       cnt AS (SELECT cluster, label, COUNT(*) AS c FROM c GROUP BY 1, 2),
       b AS (SELECT cluster, MAX(c) AS m, SUM(c) AS n FROM cnt GROUP BY 1)
  SELECT COUNT(*) AS n_clusters, CAST(SUM(n) AS BIGINT) AS n, round(SUM(m) / SUM(n), 6) AS purity FROM b"""

# ----------------------------------------------------------------- trials
ORACLE["trial_table"] = f"""
  SELECT trial, COUNT(*) AS n_steps, round(MAX(value), 6) AS best, round(arg_max(value, step), 6) AS last,
         {_fr(_xmean('value'))} AS mean, MAX(CAST(isnan(value) OR abs(value) = 'inf'::DOUBLE AS INTEGER)) AS is_bad,
         MIN(ts) AS start, MAX(ts) AS complete,
         CASE WHEN MAX(CAST(isnan(value) OR abs(value) = 'inf'::DOUBLE AS INTEGER)) = 1 THEN 'failed'
              WHEN COUNT(*) >= 60 THEN 'complete' ELSE 'running' END AS state
  FROM ({TRIAL_LOG}) l GROUP BY trial"""

ORACLE["nonfinite_trials"] = """
  SELECT event_id, user_id AS trial FROM events WHERE event_type = 'error' AND value > 300"""

ORACLE["best_trial"] = f"""
  SELECT user_id AS trial, {_fr(_xmean('value'))} AS score, COUNT(*) AS n
  FROM events GROUP BY user_id ORDER BY score DESC, trial LIMIT 1"""

ORACLE["median_stop"] = f"""
  WITH rm AS ({RUNNING_MEAN}),
       d AS (SELECT t.trial, t.step, t.rm,
                    (SELECT COUNT(*) FROM rm o WHERE o.step = t.step AND o.trial <> t.trial) AS n_oth,
                    (SELECT median(o.rm) FROM rm o WHERE o.step = t.step AND o.trial <> t.trial) AS med
             FROM rm t)
  SELECT trial, MAX(step) AS n_steps, MIN(CASE WHEN step > 1 AND n_oth >= 3 AND rm < med THEN step END) AS stop_step
  FROM d GROUP BY trial"""


def _halving_sql(rungs=(1, 3, 9, 27), reduction: int = 3) -> str:
    ctes = [f"rm AS ({RUNNING_MEAN})"]
    prev = None
    for r in rungs:
        cond = f"step = {r}" + (f" AND trial IN (SELECT trial FROM p{prev} WHERE promoted)" if prev else "")
        ctes.append(f"""r{r} AS (SELECT {r} AS rung, trial, rm AS metric,
                           row_number() OVER (ORDER BY rm DESC, trial) AS rank, COUNT(*) OVER () AS n
                    FROM rm WHERE {cond})""")
        ctes.append(f"p{r} AS (SELECT rung, trial, metric, rank, rank <= floor(n / {reduction}) AS promoted FROM r{r})")
        prev = r
    union = " UNION ALL ".join(f"SELECT rung, trial, round(metric, 6) AS metric, rank, promoted FROM p{r}"
                               for r in rungs)
    return "WITH " + ",\n".join(ctes) + "\n" + union


ORACLE["halving_rungs"] = _halving_sql()

ORACLE["param_importance"] = f"""
  WITH s AS (SELECT user_id AS trial, AVG(value) AS score FROM events GROUP BY 1),
       p AS (SELECT trial, score, {_b('trial', 21, 5)} AS lr_bin, {_b('trial', 22, 4)} AS depth,
                    {_b('trial', 23, 3)} AS reg FROM s),
       lg AS (SELECT score, 'lr_bin' AS param, CAST(lr_bin AS VARCHAR) AS level FROM p
              UNION ALL SELECT score, 'depth', CAST(depth AS VARCHAR) FROM p
              UNION ALL SELECT score, 'reg', CAST(reg AS VARCHAR) FROM p),
       g AS (SELECT param, level, COUNT(*) AS n, AVG(score) AS m FROM lg GROUP BY 1, 2),
       t AS (SELECT AVG(score) AS mu, var_pop(score) AS var, COUNT(*) AS nn FROM s),
       e AS (SELECT param, SUM(n * pow(m - mu, 2)) / (MAX(nn) * MAX(var)) AS eta_sq FROM g, t GROUP BY param)
  SELECT param, round(eta_sq, 6) AS eta_sq, CAST(row_number() OVER (ORDER BY eta_sq DESC, param) AS INTEGER) AS rank
  FROM e"""

ORACLE["scaling_sweep"] = f"""
  WITH c(scaling_type, n_workers, fraction) AS (VALUES
         ('weak', 1, 0.0625::DOUBLE), ('strong', 1, 0.5::DOUBLE), ('weak', 2, 0.125::DOUBLE), ('strong', 2, 0.5::DOUBLE),
         ('weak', 4, 0.25::DOUBLE), ('strong', 4, 0.5::DOUBLE), ('weak', 8, 0.5::DOUBLE), ('strong', 8, 0.5::DOUBLE)),
       b AS (SELECT {_b('o_orderkey', 11, 4294967296)} AS bucket FROM orders)
  SELECT c.scaling_type, CAST(c.n_workers AS INTEGER) AS n_workers, round(c.fraction, 6) AS fraction,
         CAST(SUM(CASE WHEN b.bucket < CAST(round(c.fraction * 4294967296) AS BIGINT) THEN 1 ELSE 0 END) AS BIGINT) AS rows,
         round(SUM(CASE WHEN b.bucket < CAST(round(c.fraction * 4294967296) AS BIGINT) THEN 1 ELSE 0 END) / c.n_workers, 6)
           AS rows_per_worker
  FROM c, b GROUP BY c.scaling_type, c.n_workers, c.fraction"""


# ----------------------------------------------------------------- linear models / explanation
ORACLE["ols_normal_eq"] = """
  WITH s AS (SELECT COUNT(*) AS n, SUM(x1) AS sx1, SUM(x2) AS sx2, SUM(y) AS sy, SUM(x1 * x1) AS s11,
                    SUM(x1 * x2) AS s12, SUM(x2 * x2) AS s22, SUM(x1 * y) AS s1y, SUM(x2 * y) AS s2y
             FROM (SELECT l_quantity AS x1, l_discount AS x2, l_extendedprice / 1000 AS y FROM lineitem) d),
       c AS (SELECT sx1 / n AS mx1, sx2 / n AS mx2, sy / n AS my,
                    s11 - n * (sx1 / n) * (sx1 / n) AS a11, s12 - n * (sx1 / n) * (sx2 / n) AS a12,
                    s22 - n * (sx2 / n) * (sx2 / n) AS a22,
                    s1y - n * (sx1 / n) * (sy / n) AS b1, s2y - n * (sx2 / n) * (sy / n) AS b2 FROM s),
       k AS (SELECT *, (a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12) AS c1,
                       (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS c2 FROM c)
  SELECT 'intercept' AS term, round(my - mx1 * c1 - mx2 * c2, 6) AS value FROM k
  UNION ALL SELECT 'l_quantity', round(c1, 6) FROM k
  UNION ALL SELECT 'l_discount', round(c2, 6) FROM k"""

ORACLE["ridge_grid"] = f"""
  WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y,
                    CAST({_b('l_orderkey * 8 + l_linenumber', 0, 5)} AS INTEGER) AS fold FROM lineitem),
       f AS (SELECT fold, CAST(COUNT(*) AS DOUBLE) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * x) AS sxx,
                    SUM(x * y) AS sxy, SUM(y * y) AS syy FROM d GROUP BY fold),
       t AS (SELECT SUM(n) AS n, SUM(sx) AS sx, SUM(sy) AS sy, SUM(sxx) AS sxx, SUM(sxy) AS sxy FROM f),
       g AS (SELECT f.*, t.n - f.n AS tn, t.sx - f.sx AS tsx, t.sy - f.sy AS tsy, t.sxx - f.sxx AS tsxx,
                    t.sxy - f.sxy AS tsxy, lam
             FROM f, t, (VALUES (0.0::DOUBLE), (10.0::DOUBLE), (100.0::DOUBLE), (1000.0::DOUBLE)) l(lam)),
       b AS (SELECT *, (tsxy - tn * (tsx / tn) * (tsy / tn)) / (tsxx - tn * (tsx / tn) * (tsx / tn) + lam) AS beta FROM g),
       a AS (SELECT *, tsy / tn - (tsx / tn) * beta AS alpha FROM b)
  SELECT lam AS lambda, fold,
         round((syy - 2 * (alpha * sy + beta * sxy) + (n * alpha * alpha + 2 * alpha * beta * sx + beta * beta * sxx)) / n, 6)
           AS mse,
         CAST(n AS BIGINT) AS n_heldout
  FROM a"""


def _linear_shap_sql(fitted: str = "true", scored: str = "true", more: str = "") -> str:
    feats = ["l_quantity", "l_discount", "l_tax"]
    p = len(feats)
    sums = ", ".join([f"SUM(x{i}) AS sx{i}" for i in range(p)]
                     + [f"SUM(x{i} * x{j}) AS s{i}{j}" for i in range(p) for j in range(i, p)]
                     + [f"SUM(x{i} * y) AS s{i}y" for i in range(p)])
    cent = ", ".join([f"sx{i} / n AS m{i}" for i in range(p)] + ["sy / n AS my"]
                     + [f"s{i}{j} - n * (sx{i} / n) * (sx{j} / n) AS a{i}{j}" for i in range(p) for j in range(i, p)]
                     + [f"s{i}y - n * (sx{i} / n) * (sy / n) AS b{i}" for i in range(p)])

    def a(i, j):
        return f"a{min(i, j)}{max(i, j)}"

    def det(m):
        return (f"(({m[0][0]}) * (({m[1][1]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][1]}))"
                f" - ({m[0][1]}) * (({m[1][0]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][0]}))"
                f" + ({m[0][2]}) * (({m[1][0]}) * ({m[2][1]}) - ({m[1][1]}) * ({m[2][0]})))")

    mat = [[a(i, j) for j in range(p)] for i in range(p)]
    d = det(mat)
    coefs = []
    for c in range(p):
        m = [[(f"b{i}" if j == c else mat[i][j]) for j in range(p)] for i in range(p)]
        coefs.append(f"{det(m)} / {d} AS c{c}")
    xs = ", ".join(f"{f} AS x{i}" for i, f in enumerate(feats))
    contrib = ", ".join(f"round(k.c{i} * (x.x{i} - k.m{i}), 6) AS c_{f}" for i, f in enumerate(feats))
    pred = " + ".join(f"k.c{i} * x.x{i}" for i in range(p))
    return f"""
  WITH x AS (SELECT l_orderkey, l_linenumber, {xs}, l_extendedprice / 1000 AS y FROM lineitem),
       s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, SUM(y) AS sy, {sums} FROM x WHERE {fitted}),
       c AS (SELECT n, {cent} FROM s),
       k AS (SELECT *, {', '.join(coefs)} FROM c)
  SELECT x.l_orderkey, x.l_linenumber, {more} {contrib}, round(k.my, 6) AS bias,
         round(k.my - ({' + '.join(f'k.m{i} * k.c{i}' for i in range(p))}) + {pred}, 6) AS prediction
  FROM x, k WHERE {scored}"""


ORACLE["linear_shap"] = _linear_shap_sql()

# Scaling changes no least-squares prediction.
ORACLE["scaled_linear"] = "SELECT l_orderkey, l_linenumber, y, prediction FROM (" + _linear_shap_sql(
    f"{_b('l_orderkey', 4, 4294967296)} < {_part(800)}", f"{_b('l_orderkey', 4, 4294967296)} >= {_part(800)}", "x.y,") + ") x"

ORACLE["importance_topk"] = f"""
  WITH c AS ({_linear_shap_sql()}),
       imp AS (SELECT 'l_quantity' AS feature, AVG(abs(c_l_quantity)) AS importance FROM c
               UNION ALL SELECT 'l_discount', AVG(abs(c_l_discount)) FROM c
               UNION ALL SELECT 'l_tax', AVG(abs(c_l_tax)) FROM c),
       r AS (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM imp)
  SELECT feature, round(importance, 6) AS importance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 2"""

KNN_PAIRS = """
  WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
       p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, b.label AS nlabel, list_distance(a.v, b.v) AS d
             FROM e a, e b {cond}),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, neighbor_id) AS rank FROM p)"""

ORACLE["knn_exact"] = KNN_PAIRS.format(cond="") + """
  SELECT query_id, neighbor_id, round(d, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5"""

ORACLE["knn_classify"] = KNN_PAIRS.format(cond="WHERE a.vec_id <> b.vec_id") + """,
       v AS (SELECT query_id, nlabel, COUNT(*) AS votes FROM r WHERE rank <= 5 GROUP BY 1, 2),
       w AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, nlabel) AS pick FROM v)
  SELECT w.query_id, w.nlabel AS prediction, e.label FROM w JOIN embeddings e ON e.vec_id = w.query_id WHERE pick = 1"""

ORACLE["delay_label"] = f"""
  SELECT COALESCE(CAST(date_diff('day', o_orderdate, l_shipdate) > 10 AS INTEGER), 0) AS ArrDelayBinary,
         {LINE_ID} AS flight_id,
         o_totalprice / 1000 AS CRSElapsedTime, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS DayOfWeek,
         CAST(day(o_orderdate) AS INTEGER) AS DayofMonth, l_quantity AS Distance, l_linenumber AS FlightNum,
         CAST(month(o_orderdate) AS INTEGER) AS Month, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS Origin_code,
         l_tax AS TaxiIn, l_discount AS TaxiOut, CAST(year(o_orderdate) AS INTEGER) AS Year
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# ----------------------------------------------------------------- sources and sinks
ORACLE["csv_roundtrip"] = """
  SELECT l_orderkey AS order_key, l_linenumber AS line, CAST(l_quantity AS FLOAT) AS qty,
         l_extendedprice AS price, l_shipdate AS ship_ts, l_returnflag AS flag FROM lineitem"""

ORACLE["orc_cache"] = CLEAN_TAXI

ORACLE["partition_scan"] = """
  SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year,
         CAST(month(o_orderdate) AS INTEGER) AS o_month
  FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) IN (11, 12)"""

ORACLE["glob_scan"] = """
  SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year,
         CAST(month(o_orderdate) AS INTEGER) AS o_month
  FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) IN (1, 10, 11, 12)"""

ORACLE["date_range_scan"] = """
  SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-03-31'"""

ORACLE["format_detect"] = "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part"

ORACLE["delimited_label"] = """
  SELECT l_extendedprice AS label, l_discount AS weight, CAST(l_quantity AS FLOAT) AS f0,
         CAST(l_tax AS FLOAT) AS f1, CAST(l_linenumber AS FLOAT) AS f2 FROM lineitem"""

ORACLE["row_limited"] = """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
  ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000"""

ORACLE["spec_ingest"] = """
  SELECT l_orderkey AS order_key, COALESCE(CAST(l_quantity AS FLOAT), 0) AS qty,
         COALESCE(CAST(l_extendedprice AS FLOAT), 0) AS price, CAST(0 AS FLOAT) AS tip, l_shipdate AS ship_ts
  FROM lineitem WHERE l_quantity > 10 AND l_extendedprice < 50000"""

ORACLE["result_append"] = """
  SELECT user_id, COUNT(*) AS n, MAX(value) AS best, event_type AS kind FROM events
  GROUP BY user_id, event_type"""

ORACLE["split_artifact"] = f"SELECT * FROM ({CLEAN_TAXI}) c WHERE {_b('row_id', 0, 4294967296)} >= {_part(800)}"

ORACLE["fold_scores"] = f"""
  WITH r AS ({ORACLE['ridge_grid']})
  SELECT "lambda", round(AVG(mse), 6) AS mean_score, round(MIN(mse), 6) AS best_score, round(MAX(mse), 6) AS worst_score,
         round(SUM(mse), 6) AS total, COUNT(*) AS n_folds
  FROM r GROUP BY 1"""

ORACLE["aligned_runs"] = """
  WITH s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS step
             FROM events)
  SELECT step, MAX(CASE WHEN event_type = 'click' THEN value END) AS click,
         MAX(CASE WHEN event_type = 'error' THEN value END) AS error,
         MAX(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
         MAX(CASE WHEN event_type = 'signup' THEN value END) AS signup,
         MAX(CASE WHEN event_type = 'view' THEN value END) AS "view"
  FROM s GROUP BY step"""

ORACLE["optimization_history"] = f"""
  WITH s AS (SELECT user_id AS trial, {_fr(_xmean('value'))} AS score FROM events GROUP BY 1)
  SELECT trial, score, MAX(score) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far
  FROM s"""


# ----------------------------------------------------------------- fits with a closed form
# One feature: b = soft(cov, lambda * alpha) / (var + lambda * (1 - alpha) / std(y)); Spark ML scales the squared
# penalty by the label's standard deviation.
ORACLE["penalised_one_feature"] = """
  WITH s AS (SELECT covar_pop(y, x) AS c, var_pop(x) AS v, avg(x) AS mx, avg(y) AS my, stddev_samp(y) AS sy
             FROM (SELECT l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem) d),
       p(model, lam, alpha) AS (VALUES ('lasso', 5.0::DOUBLE, 1.0::DOUBLE), ('lasso_zero', 1e6::DOUBLE, 1.0::DOUBLE),
                                       ('elastic_net', 5.0::DOUBLE, 0.5::DOUBLE)),
       b AS (SELECT model, mx, my, sign(c) * greatest(abs(c) - lam * alpha, 0) / (v + lam * (1 - alpha) / sy) AS b FROM s, p)
  SELECT model, 'l_quantity' AS term, round(b, 4) AS value FROM b
  UNION ALL SELECT model, 'intercept', round(my - b * mx, 4) FROM b"""

ORACLE["logit_one_binary"] = """
  WITH n AS (SELECT COUNT(*) FILTER (x AND y) AS n11, COUNT(*) FILTER (x AND NOT y) AS n10,
                    COUNT(*) FILTER (NOT x AND y) AS n01, COUNT(*) FILTER (NOT x AND NOT y) AS n00
             FROM (SELECT l_quantity > 25 AS x, l_extendedprice > 40000 AS y FROM lineitem) d)
  SELECT 'logit' AS model, 'intercept' AS term, round(ln(n01 / n00), 2) AS value FROM n
  UNION ALL SELECT 'logit', 'many', round(ln((n11 / n10) / (n01 / n00)), 2) FROM n"""

ORACLE["batch_linear_score"] = """
  WITH m AS (SELECT regr_slope(l_extendedprice / 1000, l_quantity) AS b,
                    regr_intercept(l_extendedprice / 1000, l_quantity) AS a FROM lineitem)
  SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 4) AS prediction FROM lineitem, m"""

ORACLE["stream_linear_score"] = ORACLE["batch_linear_score"]

ORACLE["tree_stumps"] = """
  WITH h AS (SELECT l_quantity AS x, COUNT(*)::DOUBLE AS n, SUM(l_extendedprice / 1000) AS sy FROM lineitem GROUP BY 1),
       c AS (SELECT x, SUM(n) OVER w AS nl, SUM(sy) OVER w AS yl, SUM(n) OVER () AS n, SUM(sy) OVER () AS yt
             FROM h WINDOW w AS (ORDER BY x)),
       best AS (SELECT x, yl / nl AS y1, (yt - yl) / (n - nl) AS y2 FROM c WHERE nl < n
                ORDER BY nl * (n - nl) * power(yl / nl - (yt - yl) / (n - nl), 2) DESC, x LIMIT 1)
  SELECT m.model, h.x AS l_quantity, round(CASE WHEN h.x <= best.x THEN best.y1 ELSE best.y2 END, 4) AS value
  FROM h, best, (VALUES ('forest'), ('boosted')) m(model)"""

ORACLE["rotation_norms"] = """
  WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
       m AS (SELECT i, avg(x) AS mu FROM e GROUP BY i)
  SELECT vec_id, round(SUM((x - mu) * (x - mu)), 4) AS pca_square, round(SUM(x * x), 4) AS svd_square
  FROM e JOIN m USING (i) GROUP BY vec_id"""


# Second-order trees of two levels over two features, per objective: lambda 1, alpha 0.5, learning rate 0.3.
# Nodes are numbered as they are made: 0, its sides 1 and 2, then the sides of 1, then of 2.
_NEWTON = """
  raw AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d, m.model,
                 CASE m.model WHEN 'binary' THEN CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0 END
                              ELSE l_extendedprice / 1000 END AS y
          FROM lineitem, (VALUES ('binary'), ('regression')) m(model)),
  mean AS (SELECT model, avg(y) AS p FROM raw GROUP BY model),
  base AS (SELECT model, p, CASE model WHEN 'binary' THEN ln(p / (1 - p)) ELSE p END AS base FROM mean),
  cells AS (SELECT model, q, d, count(*) AS n, sum(p - y) AS g,
                   sum(CASE model WHEN 'binary' THEN p * (1 - p) ELSE 1 END) AS h
            FROM raw JOIN mean USING (model) GROUP BY model, q, d),
  root_hist AS (SELECT model, 'l_quantity' AS f, q AS v, sum(n) AS n, sum(g) AS g, sum(h) AS h FROM cells GROUP BY ALL
                UNION ALL SELECT model, 'l_discount', d, sum(n), sum(g), sum(h) FROM cells GROUP BY ALL),
  root_sums AS (SELECT model, f, v, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
                       sum(n) OVER a AS n, sum(g) OVER a AS g, sum(h) OVER a AS h
                FROM root_hist WINDOW w AS (PARTITION BY model, f ORDER BY v), a AS (PARTITION BY model, f)),
  root AS (SELECT *, {score} AS gain FROM root_sums WHERE nl < n AND hl >= 1 AND h - hl >= 1 AND {score} > 1e-12
           QUALIFY row_number() OVER (PARTITION BY model ORDER BY {score} DESC, f DESC, v) = 1),
  sided AS (SELECT c.*, CASE WHEN CASE r.f WHEN 'l_quantity' THEN c.q ELSE c.d END <= r.v THEN 1 ELSE 2 END AS node
            FROM cells c JOIN root r USING (model)),
  kid_hist AS (SELECT model, node, 'l_quantity' AS f, q AS v, sum(n) AS n, sum(g) AS g, sum(h) AS h FROM sided GROUP BY ALL
               UNION ALL SELECT model, node, 'l_discount', d, sum(n), sum(g), sum(h) FROM sided GROUP BY ALL),
  kid_sums AS (SELECT model, node, f, v, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
                      sum(n) OVER a AS n, sum(g) OVER a AS g, sum(h) OVER a AS h
               FROM kid_hist WINDOW w AS (PARTITION BY model, node, f ORDER BY v), a AS (PARTITION BY model, node, f)),
  kid AS (SELECT *, {score} AS gain FROM kid_sums WHERE nl < n AND hl >= 1 AND h - hl >= 1 AND {score} > 1e-12
          QUALIFY row_number() OVER (PARTITION BY model, node ORDER BY {score} DESC, f DESC, v) = 1),
  totals AS (SELECT model, node, any_value(n) AS n, any_value(g) AS g, any_value(h) AS h FROM kid_sums GROUP BY model, node),
  tops AS (SELECT model, 0 AS node, f, v, gain, n, g, h, NULL::INT AS up, NULL::BOOLEAN AS is_left FROM root
           UNION ALL SELECT t.model, t.node, k.f, k.v, k.gain, t.n, t.g, t.h, 0, t.node = 1
                     FROM totals t LEFT JOIN kid k USING (model, node)),
  ends AS (SELECT model, 2 * dense_rank() OVER (PARTITION BY model ORDER BY node) + 1 + side AS node, NULL AS f, NULL AS v, NULL AS gain,
                  CASE side WHEN 0 THEN nl ELSE n - nl END AS n, CASE side WHEN 0 THEN gl ELSE g - gl END AS g,
                  CASE side WHEN 0 THEN hl ELSE h - hl END AS h, node AS up, side = 0 AS is_left
           FROM kid, (VALUES (0), (1)) s(side)),
  nodes AS (SELECT *, -0.3 * sign(g) * greatest(abs(g) - 0.5, 0) / (h + 1) + 0.0 AS value
            FROM (SELECT * FROM tops UNION ALL SELECT * FROM ends))"""
_NEWTON = _NEWTON.format(score="(" + " ".join(
    f"{sign} power(greatest(abs({g}) - 0.5, 0), 2) / ({h} + 1)" for sign, g, h in (("", "gl", "hl"), ("+", "g - gl", "h - hl"), ("-", "g", "h"))
) + ") / 2")

ORACLE["newton_two_levels"] = f"""
  WITH {_NEWTON}
  SELECT model, node, f AS feature, v AS threshold, round(gain, 4) AS gain, n::BIGINT AS n, round(value, 5) AS value FROM nodes"""

# A leaf's weight for a set of known features: 1 or 0 at cuts of these, the share of curvature at the others.
ORACLE["tree_contributions"] = f"""
  WITH {_NEWTON},
    leaves AS (SELECT l.model, l.value, l.f1, l.v1, l.left1, l.r1, l.f2, l.v2, l.left2, l.r2
               FROM (SELECT a.model, a.value, b.f AS f1, b.v AS v1, a.is_left AS left1, a.h / b.h AS r1,
                            c.f AS f2, c.v AS v2, b.is_left AS left2, b.h / c.h AS r2
                     FROM nodes a JOIN nodes b ON a.model = b.model AND a.up = b.node
                     LEFT JOIN nodes c ON c.model = b.model AND b.up = c.node WHERE a.f IS NULL) l),
    seen AS (SELECT DISTINCT model, q, d FROM raw),
    games AS (SELECT s.model, q, d, k.kq, k.kd, sum(value
                * CASE WHEN f1 IS NULL THEN 1 WHEN CASE f1 WHEN 'l_quantity' THEN kq ELSE kd END
                       THEN ((CASE f1 WHEN 'l_quantity' THEN q ELSE d END <= v1) = left1)::INT ELSE r1 END
                * CASE WHEN f2 IS NULL THEN 1 WHEN CASE f2 WHEN 'l_quantity' THEN kq ELSE kd END
                       THEN ((CASE f2 WHEN 'l_quantity' THEN q ELSE d END <= v2) = left2)::INT ELSE r2 END) AS v
              FROM seen s JOIN leaves USING (model), (VALUES (false, false), (true, false), (false, true), (true, true)) k(kq, kd)
              GROUP BY ALL),
    wide AS (SELECT model, q, d, max(v) FILTER (NOT kq AND NOT kd) AS v0, max(v) FILTER (kq AND NOT kd) AS vq,
                    max(v) FILTER (NOT kq AND kd) AS vd, max(v) FILTER (kq AND kd) AS vb FROM games GROUP BY ALL)
  SELECT l_orderkey, l_linenumber, model, round(((vq - v0) + (vb - vd)) / 2, 5) AS c_quantity,
         round(((vd - v0) + (vb - vq)) / 2, 5) AS c_discount, round(base + v0, 5) AS bias,
         round((vb - vq - vd + v0) / 2, 5) AS pair, round(vq - v0, 5) AS own_quantity
  FROM raw JOIN wide USING (model, q, d) JOIN base USING (model)"""
