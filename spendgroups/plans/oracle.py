"""DuckDB SQL that states the result of each query on its own.

Kept apart from the Spark code: nothing here is derived from it. K-means itself
is checked on ``blobs``, whose five groups are known from the key.
"""

from __future__ import annotations

PROFILE = """
profile AS (
  SELECT c.c_custkey AS CustomerID,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
         CAST(LEAST(70, 18 + 2 * COALESCE(o.n_orders, 0)) AS INT) AS Age,
         CAST(15 + ((CAST(ROUND(c.c_acctbal * 100) AS BIGINT) + 100000) * 122)
              // 1100000 AS INT) AS AnnualIncome,
         CAST(LEAST(99, GREATEST(1, COALESCE(o.cents, 0) // 6250000)) AS INT)
              AS SpendingScore
  FROM customer c
  LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders,
                    CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
             FROM orders GROUP BY o_custkey) o
    ON c.c_custkey = o.o_custkey)"""

DIRTY = (
    PROFILE
    + """,
once AS (
  SELECT CustomerID,
         CASE WHEN CustomerID % 11 = 0 THEN NULL ELSE Gender END AS Gender,
         CASE WHEN CustomerID % 17 = 0 THEN NULL
              WHEN CustomerID % 29 = 0 THEN 75 ELSE Age END AS Age,
         CASE WHEN CustomerID % 23 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN CustomerID % 31 = 0 THEN CAST(400 AS DOUBLE)
              ELSE CAST(AnnualIncome AS DOUBLE) END AS AnnualIncome,
         CASE WHEN CustomerID % 37 = 0 THEN NULL
              ELSE CAST(SpendingScore AS DOUBLE) END AS SpendingScore
  FROM profile),
dirty AS (
  SELECT * FROM once
  UNION ALL
  SELECT * FROM once WHERE CustomerID % 50 = 0),
numbers AS (
  SELECT CustomerID, Gender, CAST(Age AS DOUBLE) AS Age,
         CASE WHEN NOT isnan(AnnualIncome) THEN AnnualIncome END AS AnnualIncome,
         SpendingScore
  FROM dirty)"""
)

BLOBS = """
blobs AS (
  SELECT c_custkey AS CustomerID,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
         CASE WHEN c_custkey % 9 = 0 THEN NULL
              ELSE CAST(18 + c_custkey % 50 AS INT) END AS Age,
         CAST(CASE c_custkey % 5 WHEN 0 THEN 88 WHEN 1 THEN 88 WHEN 2 THEN 25
                                 WHEN 3 THEN 25 ELSE 55 END
              + (c_custkey // 5) % 7 - 3 AS DOUBLE) AS AnnualIncome,
         CAST(CASE c_custkey % 5 WHEN 0 THEN 82 WHEN 1 THEN 17 WHEN 2 THEN 80
                                 WHEN 3 THEN 20 ELSE 50 END
              + (c_custkey // 35) % 9 - 4 AS DOUBLE) AS SpendingScore,
         c_custkey % 5 AS part
  FROM customer),
ids AS (
  SELECT part, AVG(AnnualIncome) AS mean_income, AVG(SpendingScore) AS mean_score,
         CAST(ROW_NUMBER() OVER (ORDER BY ROUND(AVG(AnnualIncome), 6),
                                          ROUND(AVG(SpendingScore), 6)) - 1 AS INT) AS group_id
  FROM blobs GROUP BY part),
grouped AS (
  SELECT blobs.*, ids.group_id FROM blobs JOIN ids USING (part))"""


def _code(income: str, score: str) -> str:
    return f"""CASE WHEN {income} > 70 AND {score} > 60 THEN 'vip'
         WHEN {income} > 70 AND {score} < 40 THEN 'potential'
         WHEN {income} < 40 AND {score} > 60 THEN 'risk'
         WHEN {income} < 40 AND {score} < 40 THEN 'saver'
         ELSE 'standard' END"""


TEXTS = """
texts(code, description, action) AS (VALUES
  ('vip', 'High income, high spending', 'Give personal care and offer premium goods'),
  ('potential', 'High income, low spending', 'Suggest goods of quality to raise demand'),
  ('risk', 'Low income, high spending', 'Offer instalments and discounts'),
  ('saver', 'Low income, low spending', 'Send vouchers for everyday goods'),
  ('standard', 'Average customer', 'Keep in regular contact'))"""


def _long(source: str, cols: tuple = ("Age", "AnnualIncome", "SpendingScore"), more: str = ""):
    parts = [
        f"SELECT '{c}' AS \"column\", {more} CAST({c} AS DOUBLE) AS v "
        f"FROM {source} WHERE {c} IS NOT NULL"
        for c in cols
    ]
    return " UNION ALL ".join(parts)


def _histogram(edges: str, source: str = f"{PROFILE},", long: str = _long("profile")) -> str:
    """Bins found by comparing each value with the edges."""
    return f"""WITH {source} long AS ({long}), edges AS ({edges}),
    bins AS (
      SELECT "column", b.bin, first + b.bin * ((last - first) / bins) AS lo,
             CASE WHEN b.bin = bins - 1 THEN last
                  ELSE first + (b.bin + 1) * ((last - first) / bins) END AS hi,
             b.bin = bins - 1 AS closed
      FROM edges, LATERAL (SELECT UNNEST(range(bins)) AS bin) b)
    SELECT bins."column", CAST(bins.bin AS INT) AS bin, ROUND(lo, 6) AS lo,
           ROUND(hi, 6) AS hi, COUNT(v) AS n
    FROM bins LEFT JOIN long
      ON bins."column" = long."column" AND v >= lo AND (v < hi OR (closed AND v <= hi))
    GROUP BY bins."column", bins.bin, lo, hi"""


def _boxes(long: str, key: str, source: str) -> str:
    by = f', "{key}"' if key else ""
    return f"""WITH {source}{"," if source else ""} long AS ({long}),
    quartiles AS (
      SELECT "column"{by}, COUNT(*) AS n, quantile_cont(v, 0.25) AS q1,
             quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM long GROUP BY "column"{by}),
    marked AS (
      SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM long JOIN quartiles USING ("column"{by}))"""


def _box_rows(key: str) -> str:
    by = f', "{key}"' if key else ""
    return f"""SELECT "column"{by}, n, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median,
           ROUND(q3, 6) AS q3,
           ROUND(LEAST(MIN(v) FILTER (inside), q1), 6) AS lo,
           ROUND(GREATEST(MAX(v) FILTER (inside), q3), 6) AS hi,
           COUNT(*) FILTER (NOT inside) AS n_out
    FROM marked GROUP BY "column"{by}, n, q1, median, q3"""


def _description(c: str) -> str:
    return f"""SELECT '{c}' AS "column", COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean,
           ROUND(STDDEV_SAMP({c}), 6) AS sd, MIN({c}) AS min, MAX({c}) AS max FROM numbers"""


DESCRIBED = " UNION ALL ".join(
    _description(c) for c in ("Age", "AnnualIncome", "SpendingScore")
)

CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN NOT isnan(corr({a}, {b})) "
    f"THEN corr({a}, {b}) END AS r FROM numbers"
    for a in ("Age", "AnnualIncome", "SpendingScore")
    for b in ("Age", "AnnualIncome", "SpendingScore")
)

RAW_TEXT = (
    DIRTY
    + """,
raw AS (
  SELECT CASE WHEN CustomerID % 13 = 0 THEN 'C' || CustomerID
              ELSE CAST(CustomerID AS VARCHAR) END AS CustomerID, Gender,
         CASE WHEN CustomerID % 7 = 0 THEN CAST(Age AS VARCHAR) || '.5'
              ELSE CAST(Age AS VARCHAR) END AS Age,
         CAST(AnnualIncome AS VARCHAR) AS AnnualIncome,
         CASE WHEN CustomerID % 19 = 0 THEN 'n/a'
              ELSE CAST(SpendingScore AS VARCHAR) END AS SpendingScore
  FROM dirty),
cast_rows AS (
  SELECT CustomerID AS raw_id, Gender, TRY_CAST(CustomerID AS BIGINT) AS id,
         CAST(TRUNC(TRY_CAST(Age AS DOUBLE)) AS INT) AS age,
         CASE WHEN NOT isnan(TRY_CAST(AnnualIncome AS DOUBLE))
              THEN TRY_CAST(AnnualIncome AS DOUBLE) END AS income,
         TRY_CAST(SpendingScore AS DOUBLE) AS score
  FROM raw)"""
)

LOADED = """SELECT CustomerID, Gender, Age, CAST(AnnualIncome AS DOUBLE) AS AnnualIncome,
       CAST(SpendingScore AS DOUBLE) AS SpendingScore FROM profile"""

SCALED_BLOBS = f"""{BLOBS}, scale AS (
      SELECT AVG(AnnualIncome) AS mi, STDDEV_SAMP(AnnualIncome) AS si,
             AVG(SpendingScore) AS ms, STDDEV_SAMP(SpendingScore) AS ss FROM blobs)"""

GROUP_ROWS = f"""SELECT group_id, COUNT(*) AS n_rows, COUNT(Age) AS n_age,
       AVG(AnnualIncome) AS mean_income, AVG(SpendingScore) AS mean_score
FROM grouped GROUP BY group_id"""


def _prices(source: str, col: str, more: str = "") -> str:
    return f"""SELECT '{col}' AS "column", {more} CAST({col} AS DOUBLE) AS v FROM {source}"""


def _histogram20(source: str, long: str) -> str:
    return _histogram(
        'SELECT "column", MIN(v) AS first, MAX(v) AS last, 20 AS bins '
        'FROM long GROUP BY "column"',
        source,
        long,
    )


def _density(source: str, long: str, places: int) -> str:
    return f"""WITH {source} long AS ({long}), facts AS (
          SELECT "column", COUNT(*) AS n, MIN(v) AS first, MAX(v) AS last,
                 STDDEV_SAMP(v) * pow(COUNT(*), -0.2) AS h FROM long GROUP BY "column"),
        equal AS (SELECT "column", v, COUNT(*) AS m FROM long GROUP BY "column", v),
        grid AS (
          SELECT facts.*, CAST(i AS INT) AS point, first + i * (last - first) / 199 AS x
          FROM facts, range(200) r(i)),
        curve AS (
          SELECT "column", point, x, n, first, last,
                 SUM(m * exp(-((x - v) / h) * ((x - v) / h) / 2)) / (n * h * sqrt(2 * pi())) AS d
          FROM grid JOIN equal USING ("column")
          GROUP BY "column", point, x, n, h, first, last)
        SELECT "column", point, ROUND(x, 5) AS x, ROUND(d, {places}) AS density,
               ROUND(d * n * (last - first) / 20, 5) AS height FROM curve"""


# The group of each given (i, s): the nearest of the known means, in scaled units.
NEAREST = """
scale AS (
  SELECT STDDEV_SAMP(AnnualIncome) AS si, STDDEV_SAMP(SpendingScore) AS ss FROM blobs),
near AS (
  SELECT i, s, arg_min(group_id, pow((i - mean_income) / si, 2)
                                 + pow((s - mean_score) / ss, 2)) AS group_id
  FROM (SELECT DISTINCT i, s FROM given), ids, scale GROUP BY i, s)"""

NAMED_LIST = f"""{PROFILE},
named AS (
  SELECT CustomerID AS number, 'C-' || CustomerID AS CustomerID,
         CASE WHEN CustomerID % 11 <> 0 THEN Gender END AS Gender, Age,
         CASE WHEN CustomerID % 23 <> 0 THEN CAST(AnnualIncome AS DOUBLE) END AS AnnualIncome,
         CASE WHEN CustomerID % 37 <> 0 THEN CAST(SpendingScore AS DOUBLE) END AS SpendingScore
  FROM profile)"""

ORACLE_SQL = {
    "csv_scan": f"WITH {PROFILE} {LOADED}",
    "saved_list_round_trip": f"WITH {PROFILE} {LOADED}",
    "preview": f"WITH {PROFILE} SELECT * FROM profile ORDER BY CustomerID LIMIT 5",
    "id_list": f"WITH {PROFILE} SELECT CustomerID FROM profile",
    "lookup_by_id": f"""WITH {DIRTY}
        SELECT DISTINCT CustomerID, Gender,
               CAST(CASE WHEN CustomerID % 50 = 0 THEN 76 ELSE Age END AS INT) AS Age,
               AnnualIncome,
               CASE WHEN CustomerID % 50 = 0 THEN 100.0::DOUBLE ELSE SpendingScore END
                 AS SpendingScore,
               CASE WHEN CustomerID % 50 = 0 THEN 2 * CustomerID ELSE 2 * CustomerID + 1 END
                 AS position
        FROM numbers WHERE CustomerID IN
          (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "lookup_by_position": f"""WITH {PROFILE}, listed AS (
          SELECT ROW_NUMBER() OVER (ORDER BY CustomerID) - 1 AS position, * FROM profile)
        SELECT position, Gender, Age, CAST(AnnualIncome AS DOUBLE) AS AnnualIncome,
               CAST(SpendingScore AS DOUBLE) AS SpendingScore
        FROM listed WHERE position IN
          (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "default_values": f"""WITH {PROFILE}, given AS (
          SELECT CustomerID, Gender, CustomerID % 3 <> 0 AS use_i, CustomerID % 4 <> 0 AS use_s,
                 CASE WHEN CustomerID % 3 = 0 THEN 60.0::DOUBLE
                      ELSE CAST(AnnualIncome AS DOUBLE) END AS i,
                 CASE WHEN CustomerID % 4 = 0 THEN 50.0::DOUBLE
                      ELSE CAST(SpendingScore AS DOUBLE) END AS s
          FROM profile)
        SELECT CustomerID, Gender, 39 AS Age, i AS AnnualIncome, s AS SpendingScore,
               concat_ws('; ',
                 CASE WHEN use_i AND (i < 70 OR i > 100)
                      THEN 'AnnualIncome ' || CAST(i AS VARCHAR) || ' is outside 70-100' END,
                 CASE WHEN use_s AND (s < 10 OR s > 40)
                      THEN 'SpendingScore ' || CAST(s AS VARCHAR) || ' is outside 10-40' END)
               AS warnings
        FROM given""",
    "display_defaults": f"""WITH {PROFILE}
        SELECT CustomerID, 'Unknown' AS Gender, 0 AS Age,
               CAST(AnnualIncome AS DOUBLE) AS AnnualIncome,
               CAST(SpendingScore AS DOUBLE) AS SpendingScore FROM profile""",
    "range_warnings": f"""WITH {DIRTY}, found AS (
          SELECT CustomerID,
            CASE WHEN Age < 18 OR Age > 70
                 THEN 'Age ' || CAST(CAST(Age AS INT) AS VARCHAR) || ' is outside 18-70' END AS a,
            CASE WHEN AnnualIncome < 15 OR AnnualIncome > 137 THEN 'AnnualIncome '
                 || CAST(AnnualIncome AS VARCHAR) || ' is outside 15-137' END AS i,
            CASE WHEN SpendingScore < 1 OR SpendingScore > 99 THEN 'SpendingScore '
                 || CAST(SpendingScore AS VARCHAR) || ' is outside 1-99' END AS s
          FROM numbers)
        SELECT CustomerID, CAST((a IS NOT NULL)::INT + (i IS NOT NULL)::INT
               + (s IS NOT NULL)::INT AS INT) AS n_warnings,
               concat_ws('; ', a, i, s) AS warnings FROM found""",
    "cast_ok": f"""WITH {RAW_TEXT}
        SELECT id AS CustomerID, Gender, age AS Age, income AS AnnualIncome,
               score AS SpendingScore
        FROM cast_rows WHERE id IS NOT NULL AND age IS NOT NULL
          AND income IS NOT NULL AND score IS NOT NULL""",
    "cast_rejects": f"""WITH {RAW_TEXT}, faulty AS (
          SELECT raw_id, concat_ws(',',
                   CASE WHEN age IS NULL THEN 'Age' END,
                   CASE WHEN income IS NULL THEN 'AnnualIncome' END,
                   CASE WHEN score IS NULL THEN 'SpendingScore' END,
                   CASE WHEN id IS NULL THEN 'CustomerID' END) AS faults
          FROM cast_rows)
        SELECT raw_id AS CustomerID, faults FROM faulty WHERE faults <> ''""",
    "customer_strategy": f"""WITH {DIRTY}, {TEXTS}, coded AS (
          SELECT CustomerID, {_code("AnnualIncome", "SpendingScore")} AS code FROM numbers)
        SELECT CustomerID, code, description, action FROM coded JOIN texts USING (code)""",
    "null_nan_counts": f"WITH {DIRTY} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(SUM(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT)
            AS n_missing FROM dirty"""
        for c, test in {
            "CustomerID": "CustomerID IS NULL",
            "Gender": "Gender IS NULL",
            "Age": "Age IS NULL",
            "AnnualIncome": "AnnualIncome IS NULL OR isnan(AnnualIncome)",
            "SpendingScore": "SpendingScore IS NULL OR isnan(SpendingScore)",
        }.items()
    ),
    "row_and_duplicate_count": f"""WITH {DIRTY}
        SELECT (SELECT COUNT(*) FROM dirty) AS n_rows,
               (SELECT COUNT(*) FROM dirty)
                 - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS n_duplicates""",
    "describe_numeric": f"WITH {DIRTY} {DESCRIBED}",
    "training_domain": f"""WITH {PROFILE}, long AS ({_long("profile")})
        SELECT "column", MIN(v) AS lo, MAX(v) AS hi FROM long GROUP BY "column" """,
    "correlation_matrix": f"""WITH {DIRTY}, r AS ({CORRELATIONS})
        SELECT a, b, ROUND(r, 6) AS r FROM r""",
    "correlation_labels": f"""WITH {DIRTY}, r AS ({CORRELATIONS})
        SELECT a, b, printf('%.2f', r) AS label FROM r""",
    "table_overview": f"""WITH {DIRTY}, described AS ({DESCRIBED})
        SELECT (SELECT COUNT(*) FROM dirty) AS n_rows,
               (SELECT COUNT(*) * 5 - COUNT(CustomerID) - COUNT(Gender) - COUNT(Age)
                       - COUNT(AnnualIncome) - COUNT(SpendingScore) FROM numbers) AS n_missing,
               (SELECT ROUND(corr(Age, AnnualIncome), 6) FROM numbers) AS r_age_income,
               described.* FROM described""",
    "hist20": _histogram20(f"{PROFILE},", _long("profile")),
    "hist_prices": _histogram20("", _prices("orders", "o_totalprice")),
    "hist_auto": _histogram(
        """SELECT "column", first, last, CAST(CEIL((last - first) / CASE
                  WHEN whole THEN GREATEST(width, 1) ELSE width END) AS INT) AS bins
           FROM (SELECT "column", first, last, whole,
                        LEAST((last - first) / (log2(n) + 1),
                              GREATEST(2 * iqr * pow(n, -1.0 / 3.0),
                                       (last - first) / sqrt(n) / 2)) AS width
                 FROM (SELECT "column", MIN(v) AS first, MAX(v) AS last, COUNT(*) AS n,
                              quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr,
                              bool_and(v = floor(v)) AS whole
                       FROM long GROUP BY "column"))"""
    ),
    "density_curve": _density(f"{PROFILE},", _long("profile"), 8),
    "density_prices": _density("", _prices("orders", "o_totalprice"), 12),
    "box_prices": _boxes(
        _prices("lineitem", "l_extendedprice", "l_returnflag,"), "l_returnflag", ""
    )
    + _box_rows("l_returnflag"),
    "box_stats": _boxes(_long("numbers"), "", DIRTY) + _box_rows(""),
    "box_outliers": _boxes(_long("numbers", more="CustomerID,"), "", DIRTY)
    + 'SELECT CustomerID, "column", v AS "value" FROM marked WHERE NOT inside',
    "box_by_group": _boxes(
        _long("grouped", ("AnnualIncome", "SpendingScore"), "group_id,"), "group_id", BLOBS
    )
    + _box_rows("group_id"),
    "box_outliers_by_group": _boxes(
        f"""SELECT * FROM ({_long("numbers", more="CustomerID, Gender,")})
            WHERE Gender IS NOT NULL""",
        "Gender",
        DIRTY,
    )
    + 'SELECT CustomerID, "column", Gender, v AS "value" FROM marked WHERE NOT inside',
    "count_by_gender": f"""WITH {DIRTY}
        SELECT Gender AS "value", COUNT(*) AS n FROM dirty GROUP BY Gender""",
    "count_by_group": f"""WITH {BLOBS}
        SELECT group_id AS "value", COUNT(*) AS n FROM grouped GROUP BY group_id""",
    "points_by_gender": f"""WITH {DIRTY}
        SELECT CAST(AnnualIncome AS BIGINT) AS x_bin, CAST(SpendingScore AS BIGINT) AS y_bin,
               Gender, COUNT(*) AS n
        FROM numbers WHERE AnnualIncome IS NOT NULL AND SpendingScore IS NOT NULL
        GROUP BY ALL""",
    "points_all": f"""WITH {PROFILE}
        SELECT CAST(AnnualIncome // 5 AS BIGINT) AS x_bin,
               CAST(SpendingScore // 5 AS BIGINT) AS y_bin, COUNT(*) AS n
        FROM profile GROUP BY ALL""",
    "points_by_group": f"""WITH {BLOBS}
        SELECT CAST(AnnualIncome AS BIGINT) AS x_bin, CAST(SpendingScore AS BIGINT) AS y_bin,
               group_id, COUNT(*) AS n
        FROM grouped GROUP BY ALL""",
    "points_pyramid": """
        SELECT factor, CAST(floor(o_totalprice / (100 * factor)) AS BIGINT) AS x_bin,
               CAST(floor(o_custkey / (100 * factor)) AS BIGINT) AS y_bin, o_orderstatus,
               COUNT(*) AS n
        FROM orders, (SELECT CAST(unnest([1, 10, 100, 1000]) AS INTEGER) AS factor)
        WHERE o_totalprice IS NOT NULL AND o_custkey IS NOT NULL
        GROUP BY ALL""",
    "standardize": f"""WITH {PROFILE}, scale AS (
          SELECT AVG(AnnualIncome) AS mi, STDDEV_SAMP(AnnualIncome) AS si,
                 AVG(SpendingScore) AS ms, STDDEV_SAMP(SpendingScore) AS ss FROM profile)
        SELECT CustomerID, ROUND((AnnualIncome - mi) / si, 6) + 0.0 AS z_income,
               ROUND((SpendingScore - ms) / ss, 6) + 0.0 AS z_score FROM profile, scale""",
    "assign_to_given_centres": f"""WITH {PROFILE},
        centres(id, i, s) AS (VALUES (0, 88, 82), (1, 88, 17), (2, 25, 80), (3, 25, 20),
                                     (4, 55, 50)),
        measured AS (
          SELECT CustomerID, id,
                 CAST((AnnualIncome - i) * (AnnualIncome - i)
                      + (SpendingScore - s) * (SpendingScore - s) AS DOUBLE) AS distance
          FROM profile, centres)
        SELECT CustomerID, CAST(id AS INT) AS centre, distance FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY CustomerID ORDER BY distance, id) AS place
          FROM measured) WHERE place = 1""",
    "nearest_violations": "SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_violations "
    "FROM customer",
    "elbow_k5_cost": f"""WITH {SCALED_BLOBS}
        SELECT 5 AS k, ROUND(SUM(
          pow((AnnualIncome - mean_income) / si, 2) + pow((SpendingScore - mean_score) / ss, 2)
        ), 5) AS cost FROM blobs JOIN ids USING (part), scale""",
    "elbow_sweep_all": f"""WITH {SCALED_BLOBS}
        SELECT CAST(k AS INT) AS k, TRUE AS has_cost, TRUE AS same_cost,
               CASE WHEN k = 5 THEN ROUND(cost, 5) END AS known_cost
        FROM range(2, 11) r(k), (
          SELECT SUM(pow((AnnualIncome - mean_income) / si, 2)
                     + pow((SpendingScore - mean_score) / ss, 2)) AS cost
          FROM blobs JOIN ids USING (part), scale)""",
    "profile_report": """SELECT COUNT(*) AS n_rows, CAST(5 AS BIGINT) AS n_groups,
               CAST(0 AS BIGINT) AS n_wrong_sizes, CAST(0 AS BIGINT) AS n_not_nearest,
               CAST(0 AS BIGINT) AS n_wrong_means, CAST(0 AS BIGINT) AS n_wrong_strategies
        FROM customer""",
    "group_report": f"""WITH {BLOBS}, {TEXTS}, rows AS ({GROUP_ROWS}), coded AS (
          SELECT *, {_code("mean_income", "mean_score")} AS code FROM rows)
        SELECT group_id, n_rows, n_age, ROUND(mean_income, 6) AS mean_income,
               ROUND(mean_score, 6) AS mean_score, code AS strategy, description, action
        FROM coded JOIN texts USING (code)""",
    "group_report_text": f"""WITH {BLOBS}, rows AS ({GROUP_ROWS})
        SELECT group_id, printf('%.1f', mean_income) AS mean_income,
               printf('%.1f', mean_score) AS mean_score,
               {_code("mean_income", "mean_score")} AS strategy FROM rows""",
    "group_report_from_fit": f"""WITH {BLOBS}, rows AS ({GROUP_ROWS})
        SELECT group_id, n_rows, ROUND(mean_income, 6) AS mean_income,
               ROUND(mean_score, 6) AS mean_score FROM rows""",
    "score_batch": f"""WITH {BLOBS}, {TEXTS}, coded AS (
          SELECT CustomerID, AnnualIncome, SpendingScore, grouped.group_id,
                 {_code("mean_income", "mean_score")} AS group_strategy,
                 {_code("AnnualIncome", "SpendingScore")} AS code
          FROM grouped JOIN ids USING (part))
        SELECT CustomerID, AnnualIncome, SpendingScore, group_id, group_strategy,
               code AS customer_strategy, description, action, 'five' AS model_name
        FROM coded JOIN texts USING (code)""",
    "score_rejects": f"""WITH {DIRTY}
        SELECT CustomerID, Gender, CAST(Age AS INT) AS Age FROM numbers
        WHERE AnnualIncome IS NULL OR SpendingScore IS NULL""",
    "score_with_warnings": f"""WITH {DIRTY}, {BLOBS}, box AS (
          SELECT CAST(MIN(Age) AS DOUBLE) AS a0, CAST(MAX(Age) AS DOUBLE) AS a1,
                 MIN(AnnualIncome) AS i0, MAX(AnnualIncome) AS i1,
                 MIN(SpendingScore) AS s0, MAX(SpendingScore) AS s1 FROM blobs)
        SELECT CustomerID, {_code("AnnualIncome", "SpendingScore")} AS customer_strategy,
               concat_ws('; ',
                 CASE WHEN Age < a0 OR Age > a1 THEN 'Age ' || CAST(CAST(Age AS INT) AS VARCHAR)
                      || ' is outside ' || a0 || '-' || a1 END,
                 CASE WHEN AnnualIncome < i0 OR AnnualIncome > i1 THEN 'AnnualIncome '
                      || AnnualIncome || ' is outside ' || i0 || '-' || i1 END,
                 CASE WHEN SpendingScore < s0 OR SpendingScore > s1 THEN 'SpendingScore '
                      || SpendingScore || ' is outside ' || s0 || '-' || s1 END) AS warnings
        FROM numbers, box WHERE AnnualIncome IS NOT NULL AND SpendingScore IS NOT NULL""",
    "score_with_defaults": f"""WITH {RAW_TEXT}, {BLOBS}, given AS (
          SELECT id AS CustomerID, age AS Age, 50.0::DOUBLE AS s, kept,
                 CASE WHEN kept THEN 60.0::DOUBLE ELSE income END AS i
          FROM (SELECT *, CAST(regexp_extract(raw_id, '[0-9]+') AS BIGINT) % 4 = 0 AS kept
                FROM cast_rows)
          WHERE id IS NOT NULL AND age IS NOT NULL AND (kept OR income IS NOT NULL)),
        {NEAREST}, box AS (
          SELECT CAST(MIN(Age) AS DOUBLE) AS a0, CAST(MAX(Age) AS DOUBLE) AS a1,
                 MIN(AnnualIncome) AS i0, MAX(AnnualIncome) AS i1 FROM blobs)
        SELECT CustomerID, Age, i AS AnnualIncome, s AS SpendingScore, group_id,
               {_code("i", "s")} AS customer_strategy,
               concat_ws('; ',
                 CASE WHEN Age < a0 OR Age > a1 THEN 'Age ' || Age
                      || ' is outside ' || a0 || '-' || a1 END,
                 CASE WHEN NOT kept AND (i < i0 OR i > i1) THEN 'AnnualIncome '
                      || i || ' is outside ' || i0 || '-' || i1 END) AS warnings
        FROM given JOIN near USING (i, s), box""",
    "score_rows_in_memory": f"""WITH {BLOBS}, given AS (
          SELECT MIN(CustomerID) AS CustomerID, MIN(Gender) AS Gender, MIN(Age) AS Age,
                 MAX(AnnualIncome) AS i, MAX(SpendingScore) AS s FROM blobs GROUP BY part),
        {NEAREST}
        SELECT CustomerID, Gender, Age, i AS AnnualIncome, s AS SpendingScore, group_id,
               {_code("mean_income", "mean_score")} AS group_strategy,
               {_code("i", "s")} AS customer_strategy
        FROM given JOIN near USING (i, s) JOIN ids USING (group_id)""",
    "score_listed": f"""WITH {NAMED_LIST}, {BLOBS}, given AS (
          SELECT *, AnnualIncome AS i, SpendingScore AS s FROM named
          WHERE AnnualIncome IS NOT NULL AND SpendingScore IS NOT NULL AND number IN
            (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')),
        {NEAREST}
        SELECT CustomerID, Gender, 39 AS Age, i AS AnnualIncome, s AS SpendingScore, group_id,
               {_code("i", "s")} AS customer_strategy, 'five' AS model_name
        FROM given JOIN near USING (i, s)""",
    "flow_train": f"""WITH {BLOBS}, rows AS ({GROUP_ROWS}),
        poor AS (SELECT COUNT(*) AS n_rejects FROM blobs WHERE CustomerID % 7 = 0)
        SELECT group_id, n_rows, n_age, ROUND(mean_income, 6) AS mean_income,
               ROUND(mean_score, 6) AS mean_score,
               {_code("mean_income", "mean_score")} AS strategy, n_rows AS n_assigned, n_rejects
        FROM rows, poor""",
    "flow_explore": _boxes(_long("numbers"), "", DIRTY)
    + """SELECT 'duplicates' AS name, 'rows' AS "of",
               (SELECT COUNT(*) FROM dirty) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS n
        UNION ALL SELECT 'histogram', "column", COUNT(*) FROM marked GROUP BY "column"
        UNION ALL SELECT 'boxes', "column", COUNT(*) FROM marked GROUP BY "column"
        UNION ALL SELECT 'outliers', "column", COUNT(*) FROM marked WHERE NOT inside GROUP BY "column"
        UNION ALL SELECT 'genders', Gender, COUNT(*) FROM dirty GROUP BY Gender
        UNION ALL SELECT 'points', 'rows', COUNT(*) FROM numbers
          WHERE AnnualIncome IS NOT NULL AND SpendingScore IS NOT NULL
        UNION ALL SELECT 'points_by_gender', Gender, COUNT(*) FROM numbers
          WHERE AnnualIncome IS NOT NULL AND SpendingScore IS NOT NULL GROUP BY Gender""",
    "form_limits": f"""WITH {DIRTY},
        forms(form, a0, a1, i0, i1, s0, s1) AS (VALUES
          ('entry', 0, 120, 0, 500, 0, 200), ('strict', 18, 100, 10, 200, 1, 100)),
        found AS (
          SELECT CustomerID, form,
            CASE WHEN Age < a0 OR Age > a1 THEN 'Age ' || CAST(CAST(Age AS INT) AS VARCHAR)
                 || ' is outside ' || a0 || '-' || a1 END AS a,
            CASE WHEN AnnualIncome < i0 OR AnnualIncome > i1 THEN 'AnnualIncome '
                 || CAST(AnnualIncome AS VARCHAR) || ' is outside ' || i0 || '-' || i1 END AS i,
            CASE WHEN SpendingScore < s0 OR SpendingScore > s1 THEN 'SpendingScore '
                 || CAST(SpendingScore AS VARCHAR) || ' is outside ' || s0 || '-' || s1 END AS s
          FROM numbers, forms)
        SELECT CustomerID, form, concat_ws('; ', a, i, s) AS warnings FROM found""",
    "score_listed_position": f"""WITH {PROFILE}, {BLOBS}, given AS (
          SELECT ROW_NUMBER() OVER (ORDER BY CustomerID) - 1 AS position, Gender, Age,
                 CAST(AnnualIncome AS DOUBLE) AS i, CAST(SpendingScore AS DOUBLE) AS s
          FROM profile),
        {NEAREST}
        SELECT position, Gender, Age, i AS AnnualIncome, s AS SpendingScore, group_id,
               {_code("i", "s")} AS customer_strategy, 'five' AS model_name
        FROM given JOIN near USING (i, s) WHERE position IN
          (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "lookup_listed_id": f"""WITH {PROFILE}
        SELECT CustomerID, Gender, Age, CAST(AnnualIncome AS DOUBLE) AS AnnualIncome,
               CAST(SpendingScore AS DOUBLE) AS SpendingScore
        FROM profile WHERE CustomerID IN
          (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "saved_list_schema": """
        SELECT f.name AS "column", f.kind AS type, (SELECT COUNT(*) FROM customer) AS n_rows
        FROM (VALUES ('CustomerID', 'string'), ('Gender', 'string'), ('Age', 'int'),
          ('AnnualIncome', 'double'), ('SpendingScore', 'double')) f(name, kind)""",
    "saved_text_list": f"WITH {NAMED_LIST} SELECT * EXCLUDE (number) FROM named",
    "model_round_trip": "SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_different "
    "FROM customer",
    "model_registry": f"""WITH {BLOBS}
        SELECT m.name, 5 AS k, m.source, TRUE AS dated, COUNT(*) AS n_rows,
               MIN(AnnualIncome) AS income_lo, MAX(AnnualIncome) AS income_hi,
               MIN(SpendingScore) AS score_lo, MAX(SpendingScore) AS score_hi
        FROM blobs, (VALUES ('first', 'ui'), ('second', 'notebook')) m(name, source)
        GROUP BY m.name, m.source""",
}

# Keeping measures changes how an overview is found, not what it says.
ORACLE_SQL["overview_after_append"] = ORACLE_SQL["table_overview"]
ORACLE_SQL["fit_from_rows"] = f"""WITH {PROFILE}
    SELECT COUNT(*) AS n_rows, CAST(5 AS BIGINT) AS n_groups, TRUE AS agree FROM profile"""
