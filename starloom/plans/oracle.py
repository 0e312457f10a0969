"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement recomputes its answer from the driver tables with plain SQL
(independently of the Spark code): the derived sheets, the conform step, the
warehouse tables, then the report. Two data-dependent outcomes of the conform
step are written out as the SQL's fixed shape: the two ``Dayweek`` copies
differ on the driver data (the crash copy becomes ``Dayweek_dup``) and the two
``Christmas Period`` copies are equal by construction (one is dropped).
"""

from __future__ import annotations

# Fixed values shared with the Spark side (see starloom.plans.catalog).
Q2_YEAR = 1998
Q5_AFTER = 1998
SEP = " | "

_ORDER = ("l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, "
          "l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate")


def _xmas(d: str) -> str:
    return (f"CASE WHEN (month({d}) = 12 AND day({d}) >= 23) OR (month({d}) = 1 AND day({d}) <= 3) "
            f"THEN 'Yes' ELSE 'No' END")


def _person(crash: str, age: str, gender: str, user: str) -> str:
    parts = " || '_' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in (crash, age, gender, user))
    return f"replace({parts}, ' ', '_')"


BASE = f"""
fat AS (
  SELECT l.l_orderkey AS crash_id,
         CAST(year(l.l_shipdate) AS INTEGER) AS f_year,
         CAST(month(l.l_shipdate) AS INTEGER) AS f_month,
         dayname(l.l_shipdate) AS dayweek,
         CASE l.l_linestatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' END AS gender,
         p.p_size AS age,
         CASE WHEN p.p_size <= 16 THEN '0_to_16' WHEN p.p_size <= 25 THEN '17_to_25'
              WHEN p.p_size <= 39 THEN '26_to_39' WHEN p.p_size <= 64 THEN '40_to_64'
              ELSE '65_or_older' END AS age_group,
         CASE l.l_returnflag WHEN 'A' THEN 'Pedestrian' WHEN 'N' THEN 'Driver'
              WHEN 'R' THEN 'Motorcycle rider' END AS road_user,
         CASE WHEN l.l_linenumber % 2 = 1 THEN 'Day' ELSE 'Night' END AS f_time_of_day,
         p.p_type AS f_road_type,
         {_xmas('o.o_orderdate')} AS christmas,
         row_number() OVER (ORDER BY {_ORDER}) AS rn
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
),
lines AS (
  SELECT l_orderkey, max(l_quantity) AS max_q, max(p_type) AS max_type,
         max(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END) AS has_promo,
         max(CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0 END) AS has_large,
         max(CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END) AS has_economy
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
),
crash AS (
  SELECT o.o_orderkey AS crash_id,
         upper(lower(r.r_name)) AS state,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         dayname(o.o_orderdate) AS dayweek_dup,
         lpad(CAST(o.o_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o.o_custkey % 60 AS VARCHAR), 2, '0')
           AS crash_time,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'Unknown' ELSE o.o_orderpriority END AS time_of_day,
         n.n_name AS lga_name,
         c.c_mktsegment AS remoteness,
         CASE WHEN o.o_orderstatus = 'P' THEN '-9' WHEN ln.has_promo = 1 THEN 'Yes' ELSE 'No' END AS bus,
         CASE WHEN ln.has_large = 1 THEN 'Yes' ELSE 'No' END AS heavy,
         CASE WHEN ln.has_economy = 1 THEN 'Yes' ELSE 'No' END AS artic,
         CASE WHEN ln.max_q IS NULL THEN NULL WHEN o.o_orderstatus = 'P' THEN '-9'
              WHEN ln.max_q < 5 THEN '<40' ELSE CAST(CAST(ln.max_q * 4 AS BIGINT) AS VARCHAR) END AS speed,
         CASE WHEN ln.max_type = 'STANDARD' THEN 'Undetermined' ELSE ln.max_type END AS road_type,
         CASE WHEN month(o.o_orderdate) = 4 THEN 'Yes' ELSE 'No' END AS easter,
         {_xmas('o.o_orderdate')} AS c_christmas
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN lines ln ON o.o_orderkey = ln.l_orderkey
),
cf AS (
  SELECT f.crash_id, f.dayweek, f.gender, f.age, f.age_group, f.road_user, f.christmas,
         c.state, c.year, c.month, c.dayweek_dup, c.crash_time, c.time_of_day, c.lga_name, c.remoteness,
         c.bus, c.heavy, c.artic, c.speed, c.road_type, c.easter, f.rn,
         f.f_year, f.f_month, f.f_road_type, c.c_christmas
  FROM fat f LEFT JOIN crash c ON f.crash_id IS NOT DISTINCT FROM c.crash_id
),
fcnt AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS nf FROM lineitem GROUP BY 1),
ccnt AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS nc FROM orders GROUP BY 1),
cc AS (
  SELECT f.d AS date, dayname(f.d) AS dayweek, f.nf, c.nc, row_number() OVER (ORDER BY f.d) AS rn
  FROM fcnt f LEFT JOIN ccnt c ON f.d IS NOT DISTINCT FROM c.d
),
dw AS (
  SELECT n.n_name AS lga_name, CAST(count(c.c_custkey) AS BIGINT) AS dwelling_count
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_nationkey, n.n_name
),
dim_date AS (
  SELECT DISTINCT date AS date_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day, dayname(date) AS day_of_week, dayofweek(date) IN (0, 6) AS is_weekend
  FROM cc
),
dim_state AS (
  SELECT state_id, CASE state_id
      WHEN 'NSW' THEN 'New South Wales' WHEN 'VIC' THEN 'Victoria' WHEN 'QLD' THEN 'Queensland'
      WHEN 'SA' THEN 'South Australia' WHEN 'WA' THEN 'Western Australia' WHEN 'TAS' THEN 'Tasmania'
      WHEN 'NT' THEN 'Northern Territory' WHEN 'ACT' THEN 'Australian Capital Territory'
      ELSE state_id END AS state_name
  FROM (SELECT DISTINCT state AS state_id FROM cf)
),
lga_combo AS (
  SELECT lga_name, state, remoteness, min(rn) AS rn FROM cf GROUP BY lga_name, state, remoteness
),
lga_all AS (
  SELECT lc.lga_name, lc.remoteness AS national_remoteness_area, ds.state_id, dw.dwelling_count, lc.rn,
         dw.lga_name AS dw_rn
  FROM lga_combo lc
  LEFT JOIN dim_state ds ON lc.state IS NOT DISTINCT FROM ds.state_id
  LEFT JOIN dw ON lc.lga_name IS NOT DISTINCT FROM dw.lga_name
  WHERE lc.lga_name IS NOT NULL
),
lga_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lga_name ORDER BY rn, dw_rn NULLS FIRST) AS k FROM lga_all
  ) WHERE k = 1
),
dim_lga AS (
  SELECT CAST(row_number() OVER (ORDER BY rn, dw_rn NULLS FIRST) - 1 AS BIGINT) AS lga_id, lga_name,
         national_remoteness_area, CAST(dwelling_count AS BIGINT) AS dwelling_count, state_id
  FROM lga_first
),
dim_time AS (SELECT DISTINCT crash_id, crash_time, time_of_day FROM cf),
dim_vehicle AS (
  SELECT crash_id, nullif(bus, '-9') AS "Bus Involvement", nullif(heavy, '-9') AS "Heavy Rigid Truck Involvement",
         nullif(artic, '-9') AS "Articulated Truck Involvement"
  FROM (SELECT DISTINCT crash_id, bus, heavy, artic FROM cf)
),
dim_person AS (
  SELECT {_person('crash_id', 'age', 'gender', 'road_user')} AS person_id, crash_id, gender, age, age_group, road_user
  FROM (SELECT DISTINCT crash_id, gender, age, age_group, road_user FROM cf)
),
dim_event AS (SELECT DISTINCT crash_id, christmas AS "Christmas Period", easter AS "Easter Period" FROM cf),
dim_road AS (
  SELECT crash_id, CASE WHEN sp <> -9 THEN sp END AS speed_limit, nullif(road_type, 'Undetermined') AS national_road_type
  FROM (SELECT crash_id, TRY_CAST(TRY_CAST(speed AS DOUBLE) AS BIGINT) AS sp, road_type
        FROM (SELECT DISTINCT crash_id, speed, road_type FROM cf))
),
fact_fatalities AS (
  SELECT CAST(rn - 1 AS BIGINT) AS fatality_id, {_person('crash_id', 'age', 'gender', 'road_user')} AS person_id,
         crash_id
  FROM cf
),
fc0 AS (SELECT DISTINCT crash_id, year, month, lga_name, state AS state_id FROM cf),
fact_crashes AS (
  SELECT fc0.crash_id, make_date(fc0.year, fc0.month, 1) AS date_id, CAST(l.lga_id AS BIGINT) AS lga_id, fc0.state_id
  FROM fc0 LEFT JOIN dim_lga l ON fc0.lga_name IS NOT DISTINCT FROM l.lga_name
),
fact_number AS (
  SELECT CAST(rn - 1 AS BIGINT) AS number_date_id, date AS date_id, CAST(nf AS BIGINT) AS total_fatalities,
         CAST(nc AS BIGINT) AS total_crashes
  FROM cc
),
tx0 AS (
  SELECT CASE WHEN road_user IN ('-9','nan','None','Unknown','Undetermined') THEN NULL ELSE road_user END AS ru,
         CASE WHEN age_group IN ('-9','nan','None','Unknown','Undetermined') THEN NULL ELSE age_group END AS ag,
         CASE WHEN gender IN ('-9','nan','None','Unknown','Undetermined') THEN NULL ELSE gender END AS ge,
         TRY_CAST(CASE WHEN speed IN ('-9','nan','None','Unknown','Undetermined') THEN NULL ELSE speed END AS DOUBLE)
           AS sp,
         CASE WHEN time_of_day IN ('-9','nan','None','Unknown','Undetermined') THEN NULL ELSE time_of_day END AS td,
         CASE WHEN road_type IN ('-9','nan','None','Unknown','Undetermined') THEN NULL ELSE road_type END AS rt
  FROM cf
),
tx AS (
  SELECT 'Road User=' || ru AS i1, 'Age Group=' || ag AS i2, 'Gender=' || ge AS i3,
         'Speed Category=' || CASE WHEN sp > 0 AND sp <= 60 THEN 'Low' WHEN sp > 60 AND sp <= 80 THEN 'Medium'
                                   WHEN sp > 80 AND sp <= 100 THEN 'High' WHEN sp > 100 AND sp <= 200 THEN 'Very High'
                              END AS i4,
         'Time of Day=' || td AS i5, 'National Road Type=' || rt AS i6
  FROM tx0 WHERE ru IS NOT NULL
),
txc AS (
  SELECT * FROM tx
  WHERE i1 IS NOT NULL AND i2 IS NOT NULL AND i3 IS NOT NULL AND i4 IS NOT NULL AND i5 IS NOT NULL AND i6 IS NOT NULL
),
txn AS (SELECT count(*) AS n FROM txc),
cand AS (
  SELECT list_sort(list_filter([i1, i2, i3, i4, i5, i6], lambda x: x IS NOT NULL)) AS items, count(*) AS cnt
  FROM (
    SELECT CASE WHEN g1 THEN i1 END AS i1, CASE WHEN g2 THEN i2 END AS i2, CASE WHEN g3 THEN i3 END AS i3,
           CASE WHEN g4 THEN i4 END AS i4, CASE WHEN g5 THEN i5 END AS i5, CASE WHEN g6 THEN i6 END AS i6
    FROM txc, (
      SELECT (m & 1) > 0 AS g1, (m & 2) > 0 AS g2, (m & 4) > 0 AS g3, (m & 8) > 0 AS g4, (m & 16) > 0 AS g5,
             (m & 32) > 0 AS g6
      FROM range(1, 64) t(m)
      WHERE bit_count(CAST(m AS INTEGER)) <= 3
    ) masks
  ) GROUP BY 1
),
itemsets AS (
  SELECT items, CAST(cnt AS BIGINT) AS count, cnt / (SELECT n FROM txn) AS support,
         CAST(len(items) AS INTEGER) AS size
  FROM cand WHERE cnt / (SELECT n FROM txn) >= 0.05
),
splits AS (
  SELECT s.items, s.count AS c, s.support AS s, a.items AS antecedents, a.count AS ca, a.support AS sa,
         list_filter(s.items, lambda x: NOT list_contains(a.items, x)) AS consequents
  FROM itemsets s JOIN itemsets a ON a.size < s.size AND list_has_all(s.items, a.items)
  WHERE s.size >= 2
),
rules_all AS (
  SELECT sp.antecedents, sp.consequents, sp.sa AS "antecedent support", cs.support AS "consequent support",
         sp.s AS support, sp.s / sp.sa AS confidence, (sp.s / sp.sa) / cs.support AS lift,
         sp.s - sp.sa * cs.support AS leverage,
         CASE WHEN sp.s / sp.sa = 1.0 THEN 'Infinity'::DOUBLE
              ELSE (1.0 - cs.support) / (1.0 - sp.s / sp.sa) END AS conviction,
         CASE WHEN greatest(sp.s * (1.0 - sp.sa), sp.sa * (cs.support - sp.s)) = 0 THEN 0.0
              ELSE (sp.s - sp.sa * cs.support) / greatest(sp.s * (1.0 - sp.sa), sp.sa * (cs.support - sp.s))
         END AS zhangs_metric,
         CAST(sp.c AS HUGEINT) * (SELECT n FROM txn) >= CAST(sp.ca AS HUGEINT) * cs.count AS keep
  FROM splits sp JOIN itemsets cs ON cs.items = sp.consequents
),
rules AS (SELECT * EXCLUDE (keep) FROM rules_all WHERE keep),
road_rules AS (SELECT * FROM rules WHERE len(list_filter(consequents, lambda x: contains(x, 'Road User='))) > 0)
"""


def _with(select: str) -> str:
    select = select.strip()
    if select.startswith("WITH "):  # further tables of the statement's own
        return "WITH " + BASE.strip() + ",\n" + select.removeprefix("WITH ")
    return "WITH " + BASE.strip() + "\n" + select


def _txt(col: str) -> str:
    return f"array_to_string(list_sort({col}), '{SEP}') AS {col}"


_RULE_SELECT = (f"SELECT {_txt('antecedents')}, {_txt('consequents')}, \"antecedent support\", "
                "\"consequent support\", support, confidence, lift, leverage, conviction, zhangs_metric")

_CONFORMED = """
SELECT crash_id AS "Crash ID", dayweek AS "Dayweek", gender AS "Gender", age AS "Age", age_group AS "Age Group",
       road_user AS "Road User", christmas AS "Christmas Period", state AS "State", year AS "Year",
       month AS "Month", dayweek_dup AS "Dayweek_dup", crash_time AS "Time", time_of_day AS "Time of Day",
       lga_name AS "National LGA Name 2021", remoteness AS "National Remoteness Areas",
       bus AS "Bus Involvement", heavy AS "Heavy Rigid Truck Involvement", artic AS "Articulated Truck Involvement",
       speed AS "Speed Limit", road_type AS "National Road Type", easter AS "Easter Period"
FROM cf
"""

_CONFLICTS = """
SELECT crash_id AS key, 'Year' AS "column", CAST(f_year AS VARCHAR) AS left_value,
       CAST(year AS VARCHAR) AS right_value FROM cf WHERE coalesce(f_year <> year, TRUE)
UNION ALL
SELECT crash_id, 'Month', CAST(f_month AS VARCHAR), CAST(month AS VARCHAR)
FROM cf WHERE coalesce(f_month <> month, TRUE)
UNION ALL
SELECT crash_id, 'National Road Type', f_road_type, road_type
FROM cf WHERE coalesce(f_road_type <> road_type, TRUE)
"""

_PK = """
SELECT "check", key, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT 'dim_date.date_id' AS "check", CAST(date_id AS VARCHAR) AS key, count(*) AS n_rows, date_id IS NULL AS nul
    FROM dim_date GROUP BY date_id
  UNION ALL SELECT 'dim_state.state_id', state_id, count(*), state_id IS NULL FROM dim_state GROUP BY state_id
  UNION ALL SELECT 'dim_lga.lga_id', CAST(lga_id AS VARCHAR), count(*), lga_id IS NULL FROM dim_lga GROUP BY lga_id
  UNION ALL SELECT 'dim_time.crash_id', CAST(crash_id AS VARCHAR), count(*), crash_id IS NULL FROM dim_time
    GROUP BY crash_id
  UNION ALL SELECT 'dim_vehicle.crash_id', CAST(crash_id AS VARCHAR), count(*), crash_id IS NULL FROM dim_vehicle
    GROUP BY crash_id
  UNION ALL SELECT 'dim_person.person_id', person_id, count(*), person_id IS NULL FROM dim_person GROUP BY person_id
  UNION ALL SELECT 'dim_event.crash_id', CAST(crash_id AS VARCHAR), count(*), crash_id IS NULL FROM dim_event
    GROUP BY crash_id
  UNION ALL SELECT 'dim_road.crash_id', CAST(crash_id AS VARCHAR), count(*), crash_id IS NULL FROM dim_road
    GROUP BY crash_id
  UNION ALL SELECT 'fact_fatalities.fatality_id', CAST(fatality_id AS VARCHAR), count(*), fatality_id IS NULL
    FROM fact_fatalities GROUP BY fatality_id
  UNION ALL SELECT 'fact_crashes.crash_id', CAST(crash_id AS VARCHAR), count(*), crash_id IS NULL FROM fact_crashes
    GROUP BY crash_id
  UNION ALL SELECT 'fact_number.number_date_id', CAST(number_date_id AS VARCHAR), count(*), number_date_id IS NULL
    FROM fact_number GROUP BY number_date_id
) WHERE n_rows > 1 OR nul
"""


def _fk(name: str, child: str, ck: str, parent: str, pk: str) -> str:
    return (f"SELECT '{name}' AS \"check\", CAST(k AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS n_rows FROM "
            f"(SELECT {ck} AS k FROM {child} WHERE {ck} IS NOT NULL) c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.k) GROUP BY k")


_FKS = (
    ("fact_crashes", "date_id", "dim_date", "date_id"),
    ("fact_crashes", "lga_id", "dim_lga", "lga_id"),
    ("fact_crashes", "state_id", "dim_state", "state_id"),
    ("fact_fatalities", "crash_id", "fact_crashes", "crash_id"),
    ("fact_fatalities", "person_id", "dim_person", "person_id"),
    ("dim_lga", "state_id", "dim_state", "state_id"),
    ("fact_number", "date_id", "dim_date", "date_id"),
    ("dim_event", "crash_id", "fact_crashes", "crash_id"),
    ("dim_road", "crash_id", "fact_crashes", "crash_id"),
    ("dim_vehicle", "crash_id", "fact_crashes", "crash_id"),
    ("dim_time", "crash_id", "fact_crashes", "crash_id"),
)
_FK = "\nUNION ALL\n".join(_fk(f"{c}.{ck}->{p}.{pk}", c, ck, p, pk) for c, ck, p, pk in _FKS)

# The reports, each written independently of the Spark code: top-1-with-ties
# as "equals the yearly maximum", CUBE-with-HAVING as a plain grouping of
# non-null keys, the three vehicle branches as one unnest, the rate as exact
# integer half-up rounding.
# Fatalities by year and area straight from the source sheets: each counts where its crash has an
# area and a day (the first of its month) among the days with counts.
_MONTHS = "(SELECT DISTINCT make_date(year(d), month(d), 1) AS first_day FROM fcnt WHERE day(d) = 1)"
_BY_AREA = f"""(
  SELECT year, lga_name, CAST(sum(n) AS BIGINT) AS total_fatalities FROM (
    SELECT c.year, c.lga_name, make_date(c.year, c.month, 1) AS first_day, n
    FROM crash c JOIN (SELECT crash_id, count(*) AS n FROM fat GROUP BY crash_id) USING (crash_id))
  JOIN {_MONTHS} USING (first_day) WHERE lga_name <> 'Unknown' GROUP BY year, lga_name)"""
_Q1 = f"""
SELECT year, lga_name, total_fatalities FROM {_BY_AREA}
QUALIFY total_fatalities = max(total_fatalities) OVER (PARTITION BY year)
"""

# Q2 to Q4 in the same way: a crash counts where a fatality names it.
_Q2 = f"""
SELECT coalesce(s.state_name, c.state) AS state_name, CAST(count(*) AS BIGINT) AS total_crashes
FROM crash c LEFT JOIN dim_state s ON s.state_id = c.state
WHERE c.year = {Q2_YEAR} AND c.crash_id IN (SELECT crash_id FROM fat)
  AND make_date(c.year, c.month, 1) IN (SELECT first_day FROM {_MONTHS})
GROUP BY 1
"""

_Q3 = f"""
SELECT strftime(first_day, '%A') AS day_of_week, time_of_day, CAST(sum(n) AS BIGINT) AS total_fatalities FROM (
  SELECT make_date(c.year, c.month, 1) AS first_day, c.time_of_day, n
  FROM crash c JOIN (SELECT crash_id, count(*) AS n FROM fat GROUP BY crash_id) USING (crash_id))
JOIN {_MONTHS} USING (first_day)
WHERE coalesce(time_of_day, 'Unknown') <> 'Unknown' GROUP BY ALL
"""

_Q4 = """
SELECT CAST(count(*) FILTER (f.christmas = 'Yes') AS BIGINT) AS christmas_fatalities,
       CAST(count(*) FILTER (c.easter = 'Yes') AS BIGINT) AS easter_fatalities
FROM fat f LEFT JOIN crash c USING (crash_id)
"""

_Q5 = f"""
SELECT year, vehicle_type, CAST(count(*) AS BIGINT) AS total_fatal_crashes FROM (
  SELECT CAST(dd.year AS INTEGER) AS year,
         unnest([CASE WHEN vh."Bus Involvement" = 'Yes' THEN 'Bus' END,
                 CASE WHEN vh."Heavy Rigid Truck Involvement" = 'Yes' THEN 'Heavy Rigid Truck' END,
                 CASE WHEN vh."Articulated Truck Involvement" = 'Yes' THEN 'Articulated Truck' END]) AS vehicle_type
  FROM dim_vehicle vh, fact_fatalities ff, fact_crashes fc, dim_date dd
  WHERE ff.crash_id = vh.crash_id AND fc.crash_id = vh.crash_id AND dd.date_id = fc.date_id
    AND dd.year > {Q5_AFTER})
WHERE vehicle_type IS NOT NULL
GROUP BY 1, 2
"""

_Q6 = """
SELECT lga_name, dwelling_count, total_fatalities,
       CAST((total_fatalities * 200000 + dwelling_count) // (2 * dwelling_count) AS DOUBLE) / 100.0
         AS avg_fatalities_per_1000_dwellings
FROM (SELECT c.lga_name, CAST(count(*) AS BIGINT) AS total_fatalities FROM fat JOIN crash c USING (crash_id) GROUP BY c.lga_name)
JOIN (SELECT lga_name, CAST(dwelling_count AS BIGINT) AS dwelling_count FROM dw WHERE dwelling_count IS NOT NULL) USING (lga_name)
"""

_CUBE = """
WITH placed AS (
  SELECT st.state_name AS s, CASE WHEN dd.is_weekend THEN 'true' ELSE 'false' END AS w
  FROM fact_crashes fc JOIN dim_state st USING (state_id) JOIN dim_date dd USING (date_id))
SELECT s AS state_name, w AS is_weekend, count(*) AS crashes FROM placed GROUP BY s, w
UNION ALL SELECT s, 'all', count(*) FROM placed GROUP BY s
UNION ALL SELECT 'all', w, count(*) FROM placed GROUP BY w
UNION ALL SELECT 'all', 'all', count(*) FROM placed
"""

_DETAILS = """
SELECT unnest(['time', 'vehicle', 'event', 'road']) AS detail,
       unnest([(SELECT count(*) FROM dim_time), (SELECT count(*) FROM dim_vehicle),
               (SELECT count(*) FROM dim_event), (SELECT count(*) FROM dim_road)]) AS n
"""

# half up, from whole numbers
_SHARES = """
SELECT gender, n, CAST((n * 200000 + total) // (2 * total) AS DOUBLE) / 1000 AS percent
FROM (SELECT coalesce(gender, 'unknown') AS gender, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
      FROM dim_person GROUP BY 1)
"""

_RANK_ALL = f"""
SELECT *, CAST(rank() OVER (PARTITION BY year ORDER BY total_fatalities DESC) AS INTEGER) AS rank_num FROM {_BY_AREA}
"""

# The two labels that repeat after header cleaning, and whether their copies
# differ anywhere (null equals null) - decided from the data here as well.
_DUP_COLUMNS = """
SELECT 'Dayweek' AS label,
       CASE WHEN bool_or(dayweek IS DISTINCT FROM dayweek_dup) THEN 'renamed' ELSE 'dropped' END AS action FROM cf
UNION ALL
SELECT 'Christmas Period',
       CASE WHEN bool_or(christmas IS DISTINCT FROM c_christmas) THEN 'renamed' ELSE 'dropped' END FROM cf
"""

_NO_DWELLINGS = """
SELECT lga_id, lga_name, national_remoteness_area, CAST(NULL AS BIGINT) AS dwelling_count, state_id FROM dim_lga
"""

_LOADED = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {t}"
    for t in ("dim_date", "dim_state", "dim_lga", "dim_time", "dim_vehicle", "dim_person", "dim_event", "dim_road",
              "fact_fatalities", "fact_crashes", "fact_number"))

_KEEP_FIRST = """
SELECT crash_id, road_user, age FROM (
  SELECT crash_id, road_user, age, row_number() OVER (PARTITION BY crash_id ORDER BY rn) AS k FROM fat
) WHERE k = 1
"""

_DENSE = """
SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS order_seq, o_orderkey FROM orders
"""


# Every item of the derived transactions (attribute=value).
ONE_HOT_ITEMS = (
    [f"Road User={v}" for v in ("Driver", "Motorcycle rider", "Pedestrian")]
    + [f"Age Group={v}" for v in ("0_to_16", "17_to_25", "26_to_39", "40_to_64")]
    + [f"Gender={v}" for v in ("Female", "Male")]
    + [f"Speed Category={v}" for v in ("High", "Low", "Medium", "Very High")]
    + [f"Time of Day={v}" for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")]
    + [f"National Road Type={v}" for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")]
)
_ONE_HOT = ("SELECT " + ", ".join(
    f"list_contains([i1, i2, i3, i4, i5, i6], '{it}') AS \"{it}\"" for it in sorted(ONE_HOT_ITEMS)) + " FROM txc")


def oracle_sql() -> dict[str, str]:
    wh = {
        "d1_dim_date": "SELECT * FROM dim_date",
        "d2_dim_state": "SELECT * FROM dim_state",
        "d3_dim_lga": "SELECT * FROM dim_lga",
        "d4_dim_time": "SELECT * FROM dim_time",
        "d5_dim_vehicle": "SELECT * FROM dim_vehicle",
        "d6_dim_person": "SELECT * FROM dim_person",
        "d7_dim_event": "SELECT * FROM dim_event",
        "d8_dim_road": "SELECT * FROM dim_road",
        "t1_fact_fatalities": "SELECT * FROM fact_fatalities",
        "t2_fact_crashes": "SELECT * FROM fact_crashes",
        "t3_fact_number": "SELECT * FROM fact_number",
    }
    out = {
        "b1_conform_records": _CONFORMED,
        "p6_conflict_report": _CONFLICTS,
        "b2_conform_counts": ('SELECT date AS "Date", dayweek AS "Dayweek", nf AS "Number Fatalities", '
                              'nc AS "Number of fatal crashes" FROM cc'),
        **wh,
        "a6_keep_first": _KEEP_FIRST,
        "w3_dense_ids": _DENSE,
        "k2_loaded_counts": _LOADED,
        "w1_rank_all": _RANK_ALL,
        "p3_duplicate_columns": _DUP_COLUMNS,
        "j4_no_dwellings": _NO_DWELLINGS,
        "k5_primary_keys": _PK,
        "k6_foreign_keys": _FK,
        "q1_top_lga": _Q1,
        "q2_state_crashes": _Q2,
        "q3_weekday_time": _Q3,
        "a4_cube_having": _Q3,
        "q4_holidays": _Q4,
        "q5_vehicle_types": _Q5,
        "u1_union_all": _Q5,
        "q6_dwelling_rate": _Q6,
        "s5_sql_q1": _Q1, "s5_sql_q2": _Q2, "s5_sql_q3": _Q3, "s5_sql_q4": _Q4, "s5_sql_q5": _Q5,
        "s5_sql_q6": _Q6,
        "s5_sql_rank": _RANK_ALL, "s5_sql_cube": _CUBE, "s5_sql_union": _DETAILS, "s5_sql_numeric": _SHARES,
        "s1_sheet_header": """
SELECT CASE WHEN o_orderkey % 50 <> 0 AND o_orderkey % 51 <> 0 THEN o_orderkey END AS crash_id, 
       o_orderpriority || CASE WHEN o_orderkey % 7 = 0 THEN chr(10) || 'second, "quoted" line' || chr(10)
         WHEN o_orderkey % 11 = 0 THEN ',"' || chr(10) || chr(10) || ',x,' || chr(10) ELSE '' END AS priority,
       o_orderstatus AS status, lower(o_orderstatus) AS status_again,
       CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_no FROM orders""",
        "s2_trimmed_csv": """
SELECT CASE WHEN length(lga_name) % 4 = 2 THEN lga_name || ', "of" old' ELSE lga_name END AS lga_name,
       CASE WHEN length(lga_name) % 4 <> 3 THEN dwelling_count END AS dwelling_count FROM dw""",
        "m3_level_wise": f"""
WITH lw_lines AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
lw_item AS (
  SELECT DISTINCT o_custkey AS c, unnest(['Flag=' || l_returnflag, 'Month=' || month(o_orderdate), 'Priority=' || o_orderpriority,
    'Size=' || p_size, 'Type=' || p_type]) AS i FROM lw_lines),
lw_own AS (SELECT c, i FROM lw_item WHERE i IS NOT NULL),
lw_n AS (SELECT count(DISTINCT c) AS total FROM lw_own),
lw_one AS (SELECT [i] AS items, count(*) AS cnt, i FROM lw_own GROUP BY i HAVING count(*) / (SELECT total FROM lw_n) >= 0.5),
lw_held AS (SELECT c, i FROM lw_own WHERE i IN (SELECT i FROM lw_one)),
lw_pair AS (SELECT x.i AS a, y.i AS b, count(*) AS cnt FROM lw_held x JOIN lw_held y ON x.c = y.c AND x.i < y.i
         GROUP BY ALL HAVING count(*) / (SELECT total FROM lw_n) >= 0.5),
lw_triple AS (SELECT a, b, z.i AS d, count(*) AS cnt FROM lw_pair JOIN lw_held x ON x.i = a JOIN lw_held y ON y.i = b AND y.c = x.c
           JOIN lw_held z ON z.c = x.c AND z.i > b GROUP BY ALL HAVING count(*) / (SELECT total FROM lw_n) >= 0.5),
lw_whole AS (SELECT items, cnt FROM lw_one UNION ALL SELECT [a, b], cnt FROM lw_pair UNION ALL SELECT [a, b, d], cnt FROM lw_triple)
SELECT {_txt('items')}, CAST(cnt AS BIGINT) AS count, CAST(total AS BIGINT) AS total, cnt / total AS support,
       CAST(len(items) AS INTEGER) AS size FROM lw_whole, lw_n""",
        "m3_border_support": f"""
SELECT {_txt('items')}, CAST(cnt AS BIGINT) AS count, cnt / (SELECT n FROM txn) AS support, CAST(len(items) AS INTEGER) AS size
FROM cand WHERE cnt / (SELECT n FROM txn) >= (SELECT min(support) FROM (
  SELECT support FROM itemsets WHERE size = 2 ORDER BY support DESC, array_to_string(items, '{SEP}') LIMIT 5))""",
        "k3_reload": f"SELECT *, CAST(5 AS BIGINT) AS catalog_tables FROM ({_LOADED})",
        "k3_failed_reload": f"""
WITH loaded AS ({_LOADED})
SELECT *, CAST(5 AS BIGINT) AS catalog_tables, true AS refused, CAST(0 AS BIGINT) AS offences_first,
  (SELECT n_rows FROM loaded WHERE table_name = 'fact_crashes') AS offences_second FROM loaded""",
        "k5_seeded_keys": """
SELECT 'lines.l_orderkey' AS "check", CAST(l_orderkey AS VARCHAR) AS key, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey HAVING count(*) > 1
UNION ALL SELECT 'orders.o_orderkey', 'NULL', count(*) FROM orders WHERE o_orderkey % 100 = 0 HAVING count(*) > 0""",
        "k6_seeded_keys": """
SELECT 'lines.l_orderkey->known.o_orderkey' AS "check", CAST(l_orderkey AS VARCHAR) AS key, count(*) AS n_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 100 <> 0 AND o_orderkey % 97 <> 0) GROUP BY l_orderkey
UNION ALL SELECT 'orders.o_orderkey->known.o_orderkey', CAST(o_orderkey AS VARCHAR), count(*) FROM orders
WHERE o_orderkey % 100 = 0 OR o_orderkey % 97 = 0 GROUP BY o_orderkey""",
        "d2_mapped_states": """
SELECT DISTINCT state_id, CASE state_id
    WHEN 'NSW' THEN 'New South Wales' WHEN 'VIC' THEN 'Victoria' WHEN 'QLD' THEN 'Queensland'
    WHEN 'SA' THEN 'South Australia' WHEN 'WA' THEN 'Western Australia' WHEN 'TAS' THEN 'Tasmania'
    WHEN 'NT' THEN 'Northern Territory' WHEN 'ACT' THEN 'Australian Capital Territory' ELSE state_id END AS state_name
FROM (SELECT ['NSW', 'VIC', 'QLD', 'SA', 'WA', 'TAS', 'NT', 'ACT', 'OT'][CAST(n_nationkey % 9 + 1 AS INTEGER)] AS state_id FROM nation)""",
        "etl_job": _LOADED,
        "r1_rule_job": _RULE_SELECT + " FROM road_rules",
        "s4_reload_processed": _CONFORMED,
        "k4_rules_output": _RULE_SELECT + " FROM road_rules",
        "m2_one_hot": _ONE_HOT,
        "m1_transactions": ('SELECT i1 AS "Road User", i2 AS "Age Group", i3 AS "Gender", i4 AS "Speed Category", '
                            'i5 AS "Time of Day", i6 AS "National Road Type" FROM txc'),
        "m3_frequent_itemsets": f"SELECT {_txt('items')}, count, support, size FROM itemsets",
        "m4_rules": _RULE_SELECT + " FROM rules",
        "m5_road_user_rules": _RULE_SELECT + " FROM road_rules ORDER BY lift DESC, confidence DESC",
        "m6_top_rules": _RULE_SELECT + (" FROM road_rules ORDER BY lift DESC, confidence DESC, "
                                        "array_to_string(antecedents, chr(1)), array_to_string(consequents, chr(1)) "
                                        "LIMIT 5"),
        "m7_consequent_items": "SELECT DISTINCT unnest(consequents) AS item FROM rules",
        "m7_sample_itemsets": (f"SELECT {_txt('items')}, count, support, size FROM itemsets "
                               "ORDER BY size, array_to_string(items, chr(1)) LIMIT 10"),
    }
    return {k: _with(v) for k, v in out.items()}
