"""Trees and select lists from the text that Spark prints for a plan, as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each level indents by three characters, ":  " or "   ", the last of them "+- " or ":- ".
# A command's own query is printed two levels below it, a child one level.
INDENT = r"^(?::  |   )*(?:\+- |:- )"
UNION = "Union"

_NODE = "array<struct<depth:int,text:string>>"


def indented(printed: Column) -> Column:
    """Lines as ``depth, text``; the depth is null for a line that begins no node."""

    def line(text: Column, at: Column) -> Column:
        return F.struct(F.length(F.regexp_extract(text, INDENT, 0)).alias("deep"), text.alias("text"), at.alias("at"))

    def node(x: Column) -> Column:
        depth = F.when(x["at"] == 0, 0).when(x["deep"] > 0, (x["deep"] / 3).cast("int"))
        return F.struct(depth.alias("depth"), F.substr(x["text"], x["deep"] + 1).alias("text"))

    return F.transform(F.transform(F.split(printed, "\n"), line), node)


def joined_lines(lines: Column) -> Column:
    """``indented`` lines as nodes: a line break within a node's text is put back."""

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        longer = F.struct(last["depth"].alias("depth"), F.concat(last["text"], F.lit("\n"), x["text"]).alias("text"))
        return F.when(
            x["depth"].isNull() & (F.size(acc) > 0),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer)),
        ).otherwise(F.concat(acc, F.array(x)))

    whole = F.aggregate(lines, F.array().cast(_NODE), step)
    return F.when(F.exists(lines, lambda x: x["depth"].isNull()), whole).otherwise(lines)


def reached(nodes: Column, kinds: tuple[str, ...]) -> Column:
    """Positions of the nodes of these kinds at the root, or below nothing but unions.

    A fold with a stack: the depths of the unions that lead to the node at hand. Where the
    root is none, nothing below it can be reached.
    """
    kind = lambda text: F.regexp_extract(text, r"^(\w+)", 1)
    marked = F.transform(
        nodes,
        lambda x, at: F.struct(at.alias("at"), x["depth"].alias("depth"), kind(x["text"]).alias("kind")),
    )

    def step(acc: Column, x: Column) -> Column:
        unions = F.filter(acc["unions"], lambda depth: depth < x["depth"])
        here = (x["depth"] == 0) | F.array_contains(unions, x["depth"] - 1)
        return F.struct(
            F.when(here & (x["kind"] == UNION), F.concat(unions, F.array(x["depth"]))).otherwise(unions).alias("unions"),
            F.when(here & x["kind"].isin(*kinds), F.concat(acc["found"], F.array(x["at"])))
            .otherwise(acc["found"])
            .alias("found"),
        )

    none = F.array().cast("array<int>")
    found = F.aggregate(marked, F.struct(none.alias("unions"), none.alias("found")), step, lambda acc: acc["found"])
    root = kind(F.get(nodes, F.lit(0))["text"])
    return F.when(root == UNION, found).when(root.isin(*kinds), F.array(F.lit(0))).when(root.isNotNull(), none)


def below(nodes: Column, at: Column) -> Column:
    """The nodes below the one at a position, from 0, in printed order."""
    rest = F.slice(nodes, at + 2, F.size(nodes))
    ends = F.transform(rest, lambda x, k: F.when(x["depth"] <= F.get(nodes, at)["depth"], k))
    return F.slice(rest, F.lit(1), F.coalesce(F.array_min(ends), F.size(rest)))


# --- select lists -----------------------------------------------------------------------

_PIECES = ", "
_ID = r"#\d+L?$"


def named_entries(printed: Column, names: Column) -> Column:
    """The entries of a printed select list whose output names are known, or null.

    An entry ends with its name and an id. Literals are printed as they are, without
    quotes, so neither commas nor parentheses in them can be told from the plan's own.
    """

    def step(acc: Column, piece: Column) -> Column:
        entry = F.concat(acc["open"], piece)
        stem = F.regexp_replace(entry, _ID, "")
        name = F.get(names, F.size(acc["done"]))
        ends = (stem != entry) & ((stem == name) | stem.endswith(F.concat(F.lit(" AS "), name)))
        return F.when(
            F.coalesce(ends, F.lit(False)),
            F.struct(F.concat(acc["done"], F.array(entry)).alias("done"), F.lit("").alias("open")),
        ).otherwise(F.struct(acc["done"].alias("done"), F.concat(entry, F.lit(_PIECES)).alias("open")))

    return F.aggregate(
        F.split(printed, _PIECES),
        F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open")),
        step,
        lambda acc: F.when((acc["open"] == "") & (F.size(acc["done"]) == F.size(names)), acc["done"]),
    )


def balanced_entries(printed: Column) -> Column:
    """The entries of a printed select list by its parentheses, or null.

    An entry ends with an id and outside parentheses; commas elsewhere belong to it. A
    list that does not end so holds a literal with a lone parenthesis.
    """

    def count(text: Column, other: str) -> Column:
        return F.length(F.regexp_replace(text, other, ""))

    def step(acc: Column, piece: Column) -> Column:
        entry = F.concat(acc["open"], piece)
        complete = entry.rlike(_ID) & (count(entry, "[^(]") == count(entry, "[^)]"))
        return F.when(
            complete,
            F.struct(F.concat(acc["done"], F.array(entry)).alias("done"), F.lit("").alias("open")),
        ).otherwise(F.struct(acc["done"].alias("done"), F.concat(entry, F.lit(_PIECES)).alias("open")))

    return F.aggregate(
        F.split(printed, _PIECES),
        F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open")),
        step,
        lambda acc: F.when(acc["open"] == "", acc["done"]),
    )


def printed_columns(printed: Column, is_partition: bool) -> Column:
    """A printed list of columns, ``name#1L, other#2``."""
    column = r"\s*(.+?)#(\d+)L?(?:,|$)"
    names = F.regexp_extract_all(printed, F.lit(column), F.lit(1))
    ids = F.regexp_extract_all(printed, F.lit(column), F.lit(2))
    return F.transform(
        F.arrays_zip(names.alias("name"), ids.alias("id")),
        lambda x: F.struct(
            x["id"].cast("long").alias("expr_id"),
            x["name"].alias("col_name"),
            F.lit(is_partition).alias("is_partition"),
        ),
    )


def attributes(text: Column) -> Column:
    """``name, id`` of what is printed like a column, name#1, in an expression. The name is
    its end, where it holds blanks, commas, parentheses or brackets."""
    token = r"([^\s(),\[\]]+)#(\d+)"
    names = F.regexp_extract_all(text, F.lit(token), F.lit(1))
    ids = F.regexp_extract_all(text, F.lit(token), F.lit(2))
    return F.transform(
        F.arrays_zip(names.alias("name"), ids.alias("id")),
        lambda x: F.struct(x["name"].alias("name"), x["id"].cast("long").alias("id")),
    )
