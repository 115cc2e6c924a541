"""The registered queries in plain SQL for a second engine. Used by checks only."""

from sql_checks.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
