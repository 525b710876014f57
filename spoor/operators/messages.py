"""Notification envelope: wrap, measure, compress, split, put together again."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import codec, text, versions

FITS_BY_CHARS = "fits_by_chars"
FITS_BY_BYTES = "fits_by_bytes"
OVERSIZE = "oversize"

# Repeated ids are looked up by so many buckets of their hash, whatever their number.
ID_BUCKETS = 1 << 16

PART_SCHEMA = (
    "msgId string, msgCompressionKind string, msgSplitIdx int, msgSplitCount int, message string"
)


def _version() -> Column:
    return F.struct(
        F.lit(c.MESSAGE_VERSION).alias("version"),
        F.array(*map(F.lit, c.MESSAGE_VERSION_PARTS)).alias("versionParts"),
    )


def envelope(msgs: DataFrame, source_ip: str, user: str, created_ms: Column | int) -> DataFrame:
    """Adds ``msg_json``: ``message`` (text or struct) with version and origin."""
    created = created_ms if isinstance(created_ms, Column) else F.lit(created_ms)
    wrapped = F.struct(
        _version().alias("version"),
        F.lit(c.NONE).alias("msgCompressionKind"),
        F.lit(1).alias("msgSplitIdx"),
        F.lit(1).alias("msgSplitCount"),
        F.lit(source_ip).alias("msgSourceIP"),
        F.lit(user).alias("msgCreatedBy"),
        created.cast("long").alias("msgCreationTime"),
        F.col("message"),
    )
    return msgs.withColumn("msg_json", F.to_json(wrapped)).drop("message")


def with_size_class(msgs: DataFrame, max_bytes: int = c.MAX_MESSAGE_BYTES) -> DataFrame:
    """Adds ``n_bytes`` and ``size_class``, by the cheap bound and then by real bytes."""
    bound = text.utf16_length(F.col("msg_json")) * c.MAX_BYTES_PER_CHAR
    size = F.octet_length("msg_json")
    return msgs.withColumn("n_bytes", size).withColumn(
        "size_class",
        F.when(bound <= max_bytes, FITS_BY_CHARS)
        .when(size <= max_bytes, FITS_BY_BYTES)
        .otherwise(OVERSIZE),
    )


def with_message_id(msgs: DataFrame, run_id: str) -> DataFrame:
    """Adds ``msg_id``, the same again when a task is retried or a batch replayed."""
    return msgs.withColumn("msg_id", F.concat(F.lit(run_id + "_"), F.col("msg_seq")))


def encode_large(
    msgs: DataFrame, max_bytes: int = c.MAX_MESSAGE_BYTES, compress: bool = True
) -> DataFrame:
    """Adds ``encoded``: base64 of the (compressed) bytes, null where the text fits.

    Small messages go through as nulls, so the input is read once and only oversize
    bytes reach Python.
    """
    large = F.when(F.octet_length("msg_json") > max_bytes, F.encode("msg_json", "UTF-8"))
    msgs = msgs.withColumn("_large", large)
    packed = codec.gzip_bytes(F.col("_large")) if compress else F.col("_large")
    return msgs.withColumn("encoded", text.base64_text(packed)).drop("_large")


def _part_json(msg_id, kind, index, count, body) -> Column:
    return F.to_json(
        F.struct(
            _version().alias("version"),
            msg_id.alias("msgId"),
            kind.alias("msgCompressionKind"),
            index.alias("msgSplitIdx"),
            count.alias("msgSplitCount"),
            body.alias("message"),
        )
    )


def split_large(
    msgs: DataFrame, max_bytes: int = c.MAX_MESSAGE_BYTES, compress: bool = True
) -> DataFrame:
    """``msg_json`` rows to the texts really sent, one row each.

    A text that fits is sent as it is; an oversize one encoded, and cut where even that
    is too long. Needs ``msg_id``; adds ``compression, split_idx, split_count, value``.
    """
    fits = F.col("encoded").isNull()
    if compress:
        whole = F.length("encoded") <= max_bytes
    else:
        whole = F.lit(False)
    bodies = (
        F.when(fits, F.array("msg_json"))
        .when(whole, F.array("encoded"))
        .otherwise(text.chunks(F.col("encoded"), max_bytes))
    )
    kind = F.lit(c.GZIP if compress else c.NONE)
    sent_whole = fits | whole
    parts = (
        encode_large(msgs, max_bytes, compress)
        .withColumn("_sent_whole", sent_whole)
        .withColumn("_fits", fits)
        .withColumn("_bodies", bodies)
        .drop("msg_json", "encoded")
        .withColumn("split_count", F.size("_bodies"))
    )
    others = [name for name in parts.columns if name != "_bodies"]
    # There is always a body. The outer form says so to Spark, which otherwise computes
    # them all once more to filter out empty lists.
    parts = parts.select(*others, F.posexplode_outer("_bodies").alias("_index", "_body"))
    index = F.when(F.col("_sent_whole"), F.lit(1)).otherwise(F.col("_index"))
    compression = F.when(F.col("_fits"), F.lit(c.NONE)).otherwise(kind)
    sent_id = F.when(~F.col("_fits"), F.col("msg_id"))
    value = F.when(F.col("_fits"), F.col("_body")).otherwise(
        _part_json(sent_id, compression, index, F.col("split_count"), F.col("_body"))
    )
    return (
        parts.withColumn("compression", compression)
        .withColumn("split_idx", index)
        .withColumn("value", value)
        .withColumn("msg_id", sent_id)
        .drop("_sent_whole", "_fits", "_index", "_body")
    )


def compress_large(msgs: DataFrame, max_bytes: int = c.MAX_MESSAGE_BYTES) -> DataFrame:
    """Oversize messages that fit once compressed, as single messages."""
    large = with_size_class(msgs, max_bytes).filter(F.col("size_class") == OVERSIZE)
    encoded = encode_large(large, max_bytes).filter(F.length("encoded") <= max_bytes)
    value = _part_json(
        F.col("msg_id"), F.lit(c.GZIP), F.lit(1), F.lit(1), F.col("encoded")
    )
    return encoded.withColumn("value", value).drop("msg_json", "size_class", "n_bytes")


def read_parts(received: DataFrame) -> DataFrame:
    """Adds what the envelope in ``value`` says of its part."""
    fields = {
        "msg_id": "part.msgId",
        "compression": "part.msgCompressionKind",
        "split_idx": "part.msgSplitIdx",
        "split_count": "part.msgSplitCount",
        "body": "part.message",
    }
    others = [name for name in received.columns if name not in fields]
    return received.withColumn("part", F.from_json("value", PART_SCHEMA)).select(
        *others, *[F.col(field).alias(name) for name, field in fields.items()]
    )


def _gathered(parts: DataFrame, carry: list[str]) -> DataFrame:
    # A set, because a part may have been sent twice.
    return (
        parts.filter(F.col("msg_id").isNotNull())
        .groupBy("msg_id")
        .agg(
            F.max("split_count").alias("split_count"),
            F.max("compression").alias("compression"),
            F.collect_set(F.struct("split_idx", "body")).alias("parts"),
            *[F.max(name).alias(name) for name in carry],
        )
    )


def _is_whole() -> Column:
    return F.col("split_count").eqNullSafe(F.lit(1))


def _ids_again(parts: DataFrame) -> DataFrame:
    """Hash buckets of the ids that come with a whole message and once more; ``ID_BUCKETS``
    rows at most."""
    counted = parts.groupBy("msg_id").agg(F.count("*").alias("n"), F.bool_or(_is_whole()).alias("whole"))
    return counted.filter("n > 1 AND whole").select(_id_bucket(), F.lit(True).alias("_again")).distinct()


def _id_bucket() -> Column:
    return F.pmod(F.xxhash64("msg_id"), F.lit(ID_BUCKETS)).alias("_bucket")


def reassemble(parts: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Complete messages from their parts: ``(msg_id, msg_json)`` and ``carry``.

    ``msg_json`` is null where the bytes are corrupt; see ``rejected_messages``.
    Columns to carry have one value per message, as its key. Messages of one part that came
    once stay where they are: only their ids are shuffled, to find those that came again, and
    these are gathered like the parts of a split message. ``parts`` are read three times for
    that, so they must not grow meanwhile.
    """
    carry = carry or []
    parts = parts.filter(F.col("msg_id").isNotNull())
    marked = parts.withColumn("_bucket", _id_bucket()).join(F.broadcast(_ids_again(parts)), "_bucket", "left")
    stays = _is_whole() & F.col("_again").isNull()
    complete = _gathered(marked.filter(~stays), carry).filter(F.size("parts") == F.col("split_count"))
    joined = F.array_join(F.transform(F.sort_array("parts"), lambda part: part["body"]), "")
    alone = marked.filter(stays).select("msg_id", "compression", F.coalesce("body", F.lit("")).alias("_body"), *carry)
    data = alone.unionByName(complete.select("msg_id", "compression", joined.alias("_body"), *carry))
    data = data.withColumn("_data", F.try_to_binary("_body", F.lit("base64")))
    zipped = F.col("compression") == c.GZIP
    data = data.withColumn("_plain", codec.gunzip_bytes(F.when(zipped, F.col("_data"))))
    plain = F.when(zipped, F.col("_plain")).otherwise(F.col("_data"))
    text_or_null = F.try_validate_utf8(plain.cast("string"))
    return data.select("msg_id", text_or_null.alias("msg_json"), *carry)


def rejected_messages(parts: DataFrame) -> DataFrame:
    """Messages that cannot be put together, with the reason."""
    missing = (
        _gathered(parts, [])
        .filter(F.size("parts") != F.col("split_count"))
        .select("msg_id", F.lit("missing_parts").alias("reason"))
    )
    corrupt = reassemble(parts).filter(F.col("msg_json").isNull())
    return missing.unionByName(corrupt.select("msg_id", F.lit("corrupt").alias("reason")))


def with_version_parts(df: DataFrame, col: str = "version") -> DataFrame:
    """Adds ``version_parts``, null for an invalid version."""
    return df.withColumn("version_parts", versions.version_parts(F.col(col)))


def compatible(df: DataFrame, max_version: str, col: str = "version") -> DataFrame:
    """Rows whose version is at most ``max_version``; invalid versions drop out."""
    limit = versions.version_parts(F.lit(max_version))
    return df.filter(versions.compare_parts(versions.version_parts(F.col(col)), limit) <= 0)


def clean_list(df: DataFrame, col: str) -> DataFrame:
    """Adds ``entries``: the separated list trimmed and without empty entries."""
    return df.withColumn("entries", text.clean_entries(F.col(col)))
