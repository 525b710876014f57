"""Small hand-made captures."""

from datetime import datetime

from spoor.sources.capture import RECORD_SCHEMA

AT = datetime(2024, 5, 1, 12, 0, 0)


def column(expr_id, name, is_partition=False):
    return {"expr_id": expr_id, "col_name": name, "is_partition": is_partition}


def leaf(position, table, columns=(), db="raw", kind="HiveTableRelation"):
    return {
        "leaf_pos": position,
        "relation_class": kind,
        "in_db": db,
        "in_table": table,
        "columns": list(columns),
    }


def entry(position, name, expr_id, text=None, leaves=()):
    return {
        "out_pos": position,
        "out_name": name,
        "expr_id": expr_id,
        "n_children": 0 if text is None else 1,
        "expr_text": text,
        "leaves": [
            {
                "leaf_ord": order,
                "leaf_class": "Literal" if found is None else "AttributeReference",
                "leaf_expr_id": found,
            }
            for order, found in enumerate(leaves)
        ],
    }


def write(write_id, **given):
    record = {
        "write_id": write_id,
        "thread_id": 1,
        "exec_ts": AT,
        "status": "success",
        "command_class": "InsertIntoHiveTable",
        "out_db": "mart",
        "current_db": "work",
        "out_table": "Out",
        "query_root": "Project",
        "sql_text": "INSERT INTO x",
        "run_user": None,
        "inputs": [leaf(0, "A", [column(1, "Id"), column(2, "Amount")])],
        "projections": [],
    }
    record.update(given)
    return record


def records(spark, *writes):
    return spark.createDataFrame(list(writes), RECORD_SCHEMA)
