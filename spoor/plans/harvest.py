"""From capture tables to lineage, entities and messages."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame

from spoor import constants as c
from spoor.operators import column_lineage as columns
from spoor.operators import entities, messages, nested_lineage, table_lineage, writes
from spoor.operators.relations import ACCEPTED
from spoor.session import written
from spoor.sources.capture import Capture


@dataclass(frozen=True)
class Harvest:
    """What can be derived from a set of writes; each table is planned when asked for.

    With ``staging``, a folder, the lists that bundles are made of are written there when
    asked for, so that the shuffles behind them are gone before bundles are built.
    """

    capture: Capture
    writes: DataFrame
    inputs: DataFrame
    ns: str
    strip_ids: bool
    accepted: tuple
    staging: str | None = None

    def _columns_of(self, derive, *given: DataFrame) -> DataFrame:
        tables = self.capture
        return derive(
            *given,
            tables.relation_columns,
            tables.projections,
            tables.projection_leaves,
            self.ns,
            self.strip_ids,
            self.accepted,
        )

    @cached_property
    def table_edges(self) -> DataFrame:
        return table_lineage.table_edges(self.writes, self.inputs, self.ns, self.accepted)

    @cached_property
    def named(self) -> DataFrame:
        """Writes with their names and inputs."""
        return table_lineage.named_writes(self.writes, self.inputs, self.ns, self.accepted)

    @cached_property
    def table_lineage(self) -> DataFrame:
        return table_lineage.process_records(self.named, self.ns)

    @cached_property
    def column_lineage(self) -> DataFrame:
        return self._columns_of(columns.column_lineage, self.writes, self.inputs)

    @cached_property
    def column_edges(self) -> DataFrame:
        return columns.column_edges(self.column_lineage)

    @cached_property
    def rejected(self) -> DataFrame:
        """Writes without inputs."""
        return table_lineage.rejected_writes(self.writes, self.inputs, self.accepted)

    @cached_property
    def unsupported(self) -> DataFrame:
        """Successful writes of other command classes."""
        return writes.unsupported_writes(writes.successful(self.capture.writes))

    @cached_property
    def listed(self) -> DataFrame:
        """Named writes with the lineage of all their columns as an array ``columns``."""
        bare = self.named.select("write_id", "query_root", "leaves")
        found = self._columns_of(columns.lineage_columns, bare)
        lists = entities.column_lists(self.named, found)
        return lists if self.staging is None else written(lists, f"{self.staging}/lists")

    @cached_property
    def bundles(self) -> DataFrame:
        """The entities of every write, process first, in one row."""
        return entities.bundle_lists(self.listed, self.ns)


def harvest(
    capture: Capture,
    ns: str = c.DEFAULT_NAMESPACE,
    classes=writes.SUPPORTED,
    accepted=ACCEPTED,
    strip_ids: bool = False,
    normalize_case: bool = False,
    dedupe: bool = True,
    staging: str | None = None,
) -> Harvest:
    """Lineage of the successful writes of the given command classes."""
    w = writes.harvestable(capture.writes, classes, dedupe)
    i = capture.inputs
    if normalize_case:
        ns = ns.lower()
        w, i = writes.lower_case_names(w, i)
    return Harvest(capture, w, i, ns, strip_ids, accepted, staging)


@dataclass(frozen=True)
class RecordHarvest:
    """The tables of ``Harvest`` from nested records: each record is resolved in its row, so
    that nothing is shuffled behind it."""

    records: DataFrame
    writes: DataFrame
    ns: str
    strip_ids: bool
    accepted: tuple

    @cached_property
    def named(self) -> DataFrame:
        """Writes with their names and inputs, and their nested columns."""
        return nested_lineage.named_records(self.writes, self.ns, self.accepted)

    @cached_property
    def resolved(self) -> DataFrame:
        """``named`` with the lineage of all columns as an array ``columns``."""
        return nested_lineage.with_columns(self.named, self.ns, self.strip_ids, self.accepted)

    @cached_property
    def table_edges(self) -> DataFrame:
        return nested_lineage.table_edges(self.named)

    @cached_property
    def table_lineage(self) -> DataFrame:
        return table_lineage.process_records(self.named, self.ns)

    @cached_property
    def column_lineage(self) -> DataFrame:
        return nested_lineage.column_lineage(self.resolved, self.ns)

    @cached_property
    def column_edges(self) -> DataFrame:
        return columns.column_edges(self.column_lineage)

    @cached_property
    def rejected(self) -> DataFrame:
        """Writes without inputs."""
        return nested_lineage.rejected_records(self.writes, self.accepted)

    @cached_property
    def unsupported(self) -> DataFrame:
        """Successful writes of other command classes."""
        rest = writes.unsupported_writes(writes.successful(self.records))
        return rest.drop("inputs", "projections")

    @cached_property
    def bundles(self) -> DataFrame:
        """The entities of every write, process first, in one row."""
        return entities.bundle_lists(self.resolved, self.ns)


def harvest_records(
    records: DataFrame,
    ns: str = c.DEFAULT_NAMESPACE,
    classes=writes.SUPPORTED,
    accepted=ACCEPTED,
    strip_ids: bool = False,
    normalize_case: bool = False,
    dedupe: bool = True,
) -> RecordHarvest:
    """As ``harvest``, of nested write records. ``dedupe=False`` is for records whose
    ``write_id`` is known to be unique, as those of an event log are: no shuffle is left."""
    w = writes.harvestable(records, classes, dedupe)
    if normalize_case:
        ns = ns.lower()
        w = nested_lineage.lower_case_records(w)
    return RecordHarvest(records, w, ns, strip_ids, tuple(accepted))


def messages_of(
    notifications: DataFrame,
    run_id: str,
    source_ip: str,
    user: str,
    created_ms: Column | int,
    max_bytes: int = c.MAX_MESSAGE_BYTES,
    compress: bool = True,
) -> DataFrame:
    """The texts to send for ``msg_seq, msg_key, message`` rows."""
    wrapped = messages.envelope(notifications, source_ip, user, created_ms)
    return messages.split_large(messages.with_message_id(wrapped, run_id), max_bytes, compress)
