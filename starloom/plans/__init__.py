"""Plans over the operators: the warehouse build (``warehouse``), the six
reports as DataFrame plans (``reports``) and as SQL text (``sql_text``), the
ETL and rule-mining jobs (``etl``, ``rule_job``), sheets derived from the
driver tables (``analog``), and the registered queries with their oracle SQL
(``catalog``, ``oracle``)."""
