"""Qualified names, as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spoor import constants as c


def output_database(out_db: Column, current_db: Column) -> Column:
    """The database of a written table: as given, else the session's current one."""
    return F.coalesce(out_db, current_db)


def table_name(db: Column, table: Column, ns: str) -> Column:
    """``db.table@ns``, case kept."""
    return F.concat(db, F.lit("."), table, F.lit("@" + ns))


def input_table_name(db: Column, table: Column, ns: str) -> Column:
    """Name of a read table; a missing database is ``default`` here."""
    return table_name(F.coalesce(db, F.lit(c.DEFAULT_INPUT_DATABASE)), table, ns)


def relation_name(db: Column, table: Column) -> Column:
    """Lower-cased ``db.table`` of a read table."""
    db = F.coalesce(db, F.lit(c.DEFAULT_INPUT_DATABASE))
    return F.lower(F.concat(db, F.lit("."), table))


def column_of_relation(relation: Column, column: Column, ns: str) -> Column:
    return F.concat(relation, F.lit("."), F.lower(column), F.lit("@" + ns.lower()))


def input_column_name(db: Column, table: Column, column: Column, ns: str) -> Column:
    """``db.table.col@ns``, lower-cased as a whole, namespace included."""
    return column_of_relation(relation_name(db, table), column, ns)


def output_column_name(db: Column, table: Column, column: Column, ns: str) -> Column:
    """``db.table.col@ns`` where only the column is lower-cased."""
    return F.concat(db, F.lit("."), table, F.lit("."), F.lower(column), F.lit("@" + ns))


def column_process_label(db: Column, table: Column, column: Column, ns: str) -> Column:
    """``db.table@ns:col``, the short name of a column process."""
    return F.concat(table_name(db, table, ns), F.lit(":"), F.lower(column))


def input_sort_key(qualified: Column) -> Column:
    """The bare table name: between the first dot and the first ``@``."""
    start = F.instr(qualified, ".") + F.lit(1)
    return F.substring_index(F.substring(qualified, start, F.length(qualified)), "@", 1)


def write_mode(sql_text: Column) -> Column:
    """Overwrite whenever the statement text holds that word anywhere."""
    overwrites = F.contains(F.lower(F.coalesce(sql_text, F.lit(""))), F.lit("overwrite"))
    return F.when(overwrites, c.OVERWRITE).otherwise(c.INSERT)


def process_name(sorted_inputs: Column, mode: Column, target: Column) -> Column:
    """``QUERY:in1:in2->:MODE:target``."""
    return F.concat(F.lit(c.QUERY_PREFIX), sorted_inputs, F.lit("->:"), mode, F.lit(":"), target)
