"""Operators that Spark has no single built-in for, written as DataFrame
compositions: pandas-style conforming (``conform``), dense ids and
first-row-wins (``keys``), key checks (``quality``) and association rules
with multi-item consequents (``rules``)."""
