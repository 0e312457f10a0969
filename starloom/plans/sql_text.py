"""Report questions as SQL text, run with ``spark.sql`` over the warehouse
tables as temporary views (inventory S5, U2, U3).

Each statement first counts the fatalities of every crash and joins these counts
to the crash-grain tables, as the DataFrame reports do. Six statements answer the
report questions; four more have a question of their own for ``RANK``, ``CUBE``,
``UNION ALL`` and exact ``NUMERIC`` division. Column names with spaces are written
with backticks (see :func:`run_statement` for statements that quote them).
Year constants are parameters.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Registering the views and analysing a statement happen under one lock, so
# concurrent callers with different tables cannot see each other's views
# (analysis is eager: the returned DataFrame is bound to the right tables).
_views_lock = threading.RLock()


@contextmanager
def _views(spark: SparkSession, tables: Mapping[str, DataFrame]):
    """The tables as temporary views while a statement is analysed; a view that the
    caller has under one of the names is put back, no other is left behind."""
    with _views_lock:
        before = {t.name: spark.table(t.name) for t in spark.catalog.listTables() if t.isTemporary and t.name in tables}
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        try:
            yield
        finally:
            for name in tables:
                if name in before:
                    before[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)


_DEATHS = "deaths AS (SELECT crash_id, count(fatality_id) AS n FROM fact_fatalities GROUP BY crash_id)"
_INVOLVED = ("stack(3, 'Bus', `Bus Involvement`, 'Heavy Rigid Truck', `Heavy Rigid Truck Involvement`, "
             "'Articulated Truck', `Articulated Truck Involvement`)")

# Which areas had the most fatalities of each year?
TOP_AREAS = f"""
WITH {_DEATHS},
yearly AS (
  SELECT cal.year, area.lga_name, sum(n) AS total
  FROM deaths NATURAL JOIN fact_crashes
    INNER JOIN dim_lga AS area USING (lga_id) INNER JOIN dim_date AS cal USING (date_id)
  WHERE area.lga_name <> 'Unknown'
  GROUP BY cal.year, area.lga_name),
most AS (SELECT year, max(total) AS total FROM yearly GROUP BY year)
SELECT int(year) AS year, lga_name, bigint(total) AS total_fatalities FROM yearly NATURAL JOIN most ORDER BY 1, 2
"""

# How many crashes did each state have in a year?
STATE_CRASHES = """
WITH days AS (SELECT date_id FROM dim_date WHERE year = {year}),
per_state AS (SELECT state_id, count(crash_id) AS n FROM fact_crashes LEFT SEMI JOIN days USING (date_id) GROUP BY state_id)
SELECT state_name, bigint(sum(n)) AS total_crashes
FROM per_state NATURAL JOIN dim_state GROUP BY state_name ORDER BY 2 DESC, 1
"""

# When in the week do people die?
WEEK_PATTERN = f"""
WITH {_DEATHS},
slots AS (SELECT crash_id, time_of_day FROM dim_time WHERE time_of_day <> 'Unknown'),
known AS (SELECT date_id, day_of_week FROM dim_date WHERE day_of_week IS NOT NULL)
SELECT day_of_week, time_of_day, bigint(sum(n)) AS total_fatalities
FROM deaths NATURAL JOIN slots NATURAL JOIN (SELECT crash_id, date_id FROM fact_crashes) NATURAL JOIN known
GROUP BY day_of_week, time_of_day ORDER BY 3 DESC, 1, 2
"""

# How many people die around holidays?
HOLIDAYS = f"""
WITH {_DEATHS}
SELECT bigint(sum(CASE WHEN `Christmas Period` = 'Yes' THEN n ELSE 0 END)) AS christmas_fatalities,
       bigint(sum(CASE WHEN `Easter Period` = 'Yes' THEN n ELSE 0 END)) AS easter_fatalities
FROM deaths NATURAL JOIN dim_event
"""

# How often were buses and trucks involved after a year?
VEHICLES = f"""
WITH {_DEATHS},
involved AS (
  SELECT crash_id, vehicle_type FROM dim_vehicle LATERAL VIEW {_INVOLVED} AS vehicle_type, flag WHERE flag = 'Yes'),
late AS (SELECT date_id, year FROM dim_date WHERE year > {{after}}),
rows_per_crash AS (SELECT crash_id, count(*) AS m FROM fact_fatalities GROUP BY crash_id)
SELECT int(year) AS year, vehicle_type, bigint(sum(m)) AS total_fatal_crashes
FROM involved NATURAL JOIN rows_per_crash NATURAL JOIN (SELECT crash_id, date_id FROM fact_crashes) NATURAL JOIN late
GROUP BY year, vehicle_type ORDER BY 1, 3 DESC, 2
"""

# How do fatalities compare with the dwellings of an area? (half up, from whole numbers)
RATES = f"""
WITH {_DEATHS},
per_area AS (SELECT lga_id, sum(n) AS total FROM deaths NATURAL JOIN (SELECT crash_id, lga_id FROM fact_crashes) GROUP BY lga_id),
named AS (SELECT lga_name, dwelling_count, sum(total) AS total FROM per_area NATURAL JOIN dim_lga
          WHERE dwelling_count IS NOT NULL GROUP BY lga_name, dwelling_count)
SELECT lga_name, dwelling_count, bigint(total) AS total_fatalities,
       double((total * 200000 + dwelling_count) div (2 * dwelling_count)) / 100 AS avg_fatalities_per_1000_dwellings
FROM named ORDER BY 4 DESC, 1
"""

# RANK: the place of every area in its year.
AREA_RANKS = f"""
WITH {_DEATHS},
yearly AS (
  SELECT cal.year, area.lga_name, sum(n) AS total
  FROM deaths NATURAL JOIN fact_crashes
    INNER JOIN dim_lga AS area USING (lga_id) INNER JOIN dim_date AS cal USING (date_id)
  WHERE area.lga_name <> 'Unknown' GROUP BY cal.year, area.lga_name)
SELECT int(year) AS year, lga_name, bigint(total) AS total_fatalities,
       RANK() OVER (PARTITION BY year ORDER BY total DESC) AS rank_num
FROM yearly ORDER BY 1, 4, 2
"""

# CUBE: crashes by state and weekend, with all subtotals.
CRASH_CUBE = """
SELECT coalesce(state_name, 'all') AS state_name, coalesce(string(is_weekend), 'all') AS is_weekend, count(*) AS crashes
FROM fact_crashes NATURAL JOIN dim_state NATURAL JOIN (SELECT date_id, is_weekend FROM dim_date)
GROUP BY CUBE (state_name, is_weekend) ORDER BY 1, 2
"""

# UNION ALL: rows of each dimension that describe crashes, one branch a dimension.
DETAIL_ROWS = """
SELECT 'time' AS detail, count(*) AS n FROM dim_time
UNION ALL SELECT 'vehicle', count(*) FROM dim_vehicle
UNION ALL SELECT 'event', count(*) FROM dim_event
UNION ALL SELECT 'road', count(*) FROM dim_road
"""

# NUMERIC division: each gender's share of the people, in exact decimals.
GENDER_SHARES = """
WITH people AS (SELECT coalesce(gender, 'unknown') AS gender, count(*) AS n FROM dim_person GROUP BY 1)
SELECT gender, n, double(round(CAST(n AS NUMERIC(20, 0)) * 100 / CAST(sum(n) OVER () AS NUMERIC(20, 0)), 3)) AS percent
FROM people ORDER BY 1
"""

STATEMENTS = {"q1": TOP_AREAS, "q2": STATE_CRASHES, "q3": WEEK_PATTERN, "q4": HOLIDAYS, "q5": VEHICLES, "q6": RATES,
              "rank": AREA_RANKS, "cube": CRASH_CUBE, "union": DETAIL_ROWS, "numeric": GENDER_SHARES}


def run(spark: SparkSession, tables: Mapping[str, DataFrame], name: str, year: int = 2023,
        after: int = 2010) -> DataFrame:
    """Run one statement over the tables."""
    with _views(spark, tables):
        return spark.sql(STATEMENTS[name].format(year=year, after=after))


def run_statement(spark: SparkSession, tables: Mapping[str, DataFrame], statement: str,
                  double_quoted_identifiers: bool = True) -> DataFrame:
    """Run one SQL statement as written for a PostgreSQL-style warehouse:
    ``"Christmas Period"`` is read as a column name (ANSI
    ``doubleQuotedIdentifiers``, set only while the statement is parsed and
    analysed) and a trailing semicolon is accepted. Run statements one at a
    time."""
    key = "spark.sql.ansi.doubleQuotedIdentifiers"
    with _views(spark, tables):
        previous = spark.conf.get(key, None)
        spark.conf.set(key, str(double_quoted_identifiers).lower())
        try:
            return spark.sql(statement.strip().rstrip(";"))
        finally:
            if previous is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, previous)
