"""From log messages to valid events: decode, validate, keep or reject with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import schema
from footfall.functions.keys import hyphenate
from footfall.functions.timestamps import USUAL, is_blank, parse_iso8601

HEX_32 = "^[0-9a-f]{32}$"
CANONICAL_UUID = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
WITH_PRODUCT = ["product_view", "add_to_cart"]
WITH_ORDER = ["purchase"]
#: What is read of a document at once.
READ = (
    "STRUCT<event_id: STRING, event_name: STRING, anonymous_id: STRING, occurred_at: STRING, "
    "product: STRUCT<product_id: STRING>, order: STRUCT<order_id: STRING, revenue_usd: VARIANT>>"
)
ENVELOPE = ["kafka_topic", "kafka_partition", "kafka_offset"]


def from_log(messages: DataFrame) -> DataFrame:
    """Rename the columns of Spark's Kafka source to those stored here."""
    return messages.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("key").cast("binary").alias("message_key"),
        F.col("value").cast("binary").alias("message_value"),
    )


def quoted(text: Column) -> Column:
    """Text in quotes for a reason: single ones, or double if it holds single ones."""
    for char, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(shown))
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    escaped = F.replace(text, F.lit("'"), F.lit("\\'"))
    return (
        F.when(single & ~double, F.concat(F.lit('"'), text, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))
    )


def _kind(text: Column) -> Column:
    """Type name of a valid JSON text, by how it begins."""
    first = F.substring(F.ltrim(F.regexp_replace(text, r"^\s+", "")), 1, 1)
    return (
        F.when(first == "{", "dict")
        .when(first == "[", "list")
        .when(first == '"', "str")
        .when(first.isin("t", "f"), "bool")
        .when(first == "n", "NoneType")
        .when(text.rlike("[.eE]"), "float")
        .otherwise("int")
    )


def _uuid_hex(text: Column) -> Column:
    """The 32 hex digits of a UUID, null if it is none.

    A urn:uuid: prefix, braces around it and hyphens anywhere are allowed.
    """

    def digits(t: Column) -> Column:
        return F.lower(F.replace(t, F.lit("-"), F.lit("")))

    bare = text
    for part in ("urn:", "uuid:"):
        bare = F.replace(bare, F.lit(part), F.lit(""))
    bare = digits(F.regexp_replace(bare, r"^[{}]+|[{}]+$", ""))
    return F.when(digits(text).rlike(HEX_32), digits(text)).when(bare.rlike(HEX_32), bare)


def validate_events(messages: DataFrame) -> DataFrame:
    """Adds event_id, event_name, anonymous_id, occurred_at, payload and `error`.

    `error` is null for a valid event; otherwise it is the first rule that failed,
    and the event columns are null. Input: `from_log(...)`; all its columns stay.

    Messages in the usual form are found valid by a few cheap tests on one read of the
    document; only what fails any of them is judged rule by rule.
    """
    columns = messages.columns
    raw = messages.withColumn(
        "text", F.when(F.is_valid_utf8("message_value"), F.col("message_value").cast("string"))
    )
    # Parsed as the first item of a list whose second is the text's own hash, so
    # that anything after the document, or a list end inside it, is noticed.
    mark = F.xxhash64("text")
    parsed = raw.withColumn(
        "doc",
        F.try_parse_json(F.concat(F.lit("["), F.col("text"), F.lit(","), mark.cast("string"), F.lit("]"))),
    )
    read = parsed.select(
        *columns,
        "text",
        "doc",
        F.try_variant_get("doc", "$[1]", "bigint").eqNullSafe(mark).alias("is_json"),
        F.try_variant_get("doc", "$[0]", READ).alias("read"),
    ).withColumn("usual", F.coalesce(F.col("is_json") & _in_usual_form(), F.lit(False)))

    usual = F.col("usual")
    doubtful = F.when(~usual, F.array(F.struct("message_value", "text", "doc", "is_json")))
    checked = read.withColumn("judged", F.get(F.transform(F.transform(doubtful, _fields), _judged), 0))
    error = F.col("judged.error")
    valid = usual | error.isNull()

    def either(name: str, read_: Column) -> Column:
        return F.when(usual, read_).when(valid, F.col(f"judged.{name}")).alias(name)

    event = F.struct(
        either("event_id", F.col("read.event_id")),
        either("event_name", F.col("read.event_name")),
        either("anonymous_id", F.col("read.anonymous_id")),
        either("occurred_at", F.col("read.occurred_at").try_cast("timestamp")),
        F.when(valid, F.col("text")).alias("payload"),
        error.alias("error"),
    )
    # Unpacked from a list of one: a later filter on `error` stays above this, and
    # the document is parsed once per row and not again inside the filter.
    return checked.select(*columns, F.inline(F.array(event)))


def _fields(message: Column) -> Column:
    """What the rules look at, of a message that is not in the usual form.

    Evaluated in a function over a list, as is `_judged`: it stays out of the code generated for
    all rows, which would otherwise be too long to be compiled.
    """

    def field(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(message["doc"], f"$[0]{path}", kind)

    def type_of(path: str) -> Column:
        return F.schema_of_variant(field(path, "variant"))

    product, order, revenue = ".product.product_id", ".order.order_id", ".order.revenue_usd"
    id_, at = field(".event_id"), field(".occurred_at")
    return F.struct(
        message["message_value"].alias("message_value"),
        message["text"].alias("text"),
        message["is_json"].alias("is_json"),
        id_.alias("id"),
        field(".event_name").alias("name"),
        field(".anonymous_id").alias("visitor"),
        at.alias("at"),
        field(product).alias("product"),
        type_of(product).alias("product_type"),
        field(order).alias("order"),
        type_of(order).alias("order_type"),
        field(revenue).alias("revenue"),
        type_of(revenue).alias("revenue_type"),
        _uuid_hex(id_).alias("hex"),
        parse_iso8601(at).alias("instant"),
    )


def _judged(f: Column) -> Column:
    """The first rule that failed, and the event's columns as far as they could be read."""
    return F.struct(
        _first_failure(f).alias("error"),
        hyphenate(f["hex"]).alias("event_id"),
        f["name"].alias("event_name"),
        f["visitor"].alias("anonymous_id"),
        f["instant"].alias("occurred_at"),
    )


def _in_usual_form() -> Column:
    """Surely valid: texts as producers write them. Null or false says nothing yet."""

    def text(name: str) -> Column:
        return F.col(f"read.{name}")

    def named(name: str) -> Column:
        # begins with a letter, so it is neither blank nor a number, list or object
        return text(name).rlike("^[A-Za-z]") & (text(name) != "false")

    amount = text("order.revenue_usd")
    owed = F.schema_of_variant(amount).rlike("^(BIGINT|DECIMAL|DOUBLE)") & (
        F.try_variant_get(amount, "$", "double") >= 0
    )
    name = text("event_name")
    return (
        name.isin(schema.EVENT_NAMES)
        & text("event_id").rlike(CANONICAL_UUID)
        & text("anonymous_id").rlike("^[!-~]")
        & text("occurred_at").rlike(USUAL)
        & text("occurred_at").try_cast("timestamp").isNotNull()
        & (~name.isin(WITH_PRODUCT) | named("product.product_id"))
        & (~name.isin(WITH_ORDER) | (named("order.order_id") & owed))
    )


def _given(text: Column, type_: Column) -> Column:
    """Present and not empty, zero, false or an empty list or object."""
    empty = (text == "") | (
        (type_ != "STRING")
        & (text.isin("false", "[]", "{}") | F.coalesce(text.try_cast("double") == 0, F.lit(False)))
    )
    return text.isNotNull() & ~empty


def _number(text: Column, type_: Column) -> Column:
    """A JSON number for a reason: with a fraction or exponent as a float (-8.00 is -8.0), else as it is.

    A whole number outside the 64-bit range is taken for an integer.
    """
    number = text.try_cast("double")
    size = F.abs(number)
    whole = type_.rlike(r"^BIGINT|^DECIMAL\(\d+,0\)") & (
        (type_ == "BIGINT") | text.try_cast("bigint").isNull()
    )
    digits = number.cast("string").try_cast("decimal(38,21)").cast("string")
    fixed = F.regexp_replace(digits, r"(\.\d+?)0*$", "$1")
    scientific = F.replace(number.cast("string"), F.lit("Infinity"), F.lit("inf"))
    for pattern, written in ((r"(\.0)?E(-?)", "e$2"), (r"e(\d)", "e+$1"), (r"([+-])(\d)$", "$10$2")):
        scientific = F.regexp_replace(scientific, pattern, written)
    return (
        F.when(whole, text)
        .when((size == 0) | ((size >= 1e-4) & (size < 1e16)), fixed)
        .otherwise(scientific)
    )


def _first_failure(f: Column) -> Column:
    def missing(column: str) -> Column:
        return f[column].isNull() | is_blank(f[column])

    def required(name: str) -> str:
        return f"missing required field '{name}'"

    name, needs = f["name"], F.lit(" requires product.product_id")
    amount = f["revenue"].try_cast("double")
    is_number = f["revenue_type"].rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")
    # a true or false counts as a number and is not negative
    owed = F.coalesce(is_number, F.lit(False)) & ~F.coalesce(amount < 0, F.lit(False))
    shown = (
        F.when(f["revenue"].isNull(), "None")
        .when(f["revenue_type"] == "STRING", quoted(f["revenue"]))
        .when(is_number, _number(f["revenue"], f["revenue_type"]))
        .otherwise(f["revenue"])
    )
    # The reason texts.
    return (
        F.when(f["message_value"].isNull(), "message value is empty (tombstone?)")
        .when(f["text"].isNull(), "message value is not UTF-8")
        .when(~f["is_json"], "message value is not valid JSON")
        .when(
            _kind(f["text"]) != "dict",
            F.concat(F.lit("expected a JSON object, got "), _kind(f["text"])),
        )
        .when(missing("name"), required("event_name"))
        .when(
            ~name.isin(schema.EVENT_NAMES), F.concat(F.lit("unknown event_name "), quoted(name))
        )
        .when(missing("id"), required("event_id"))
        .when(
            f["hex"].isNull(),
            F.concat(F.lit("event_id is not a UUID: "), quoted(f["id"])),
        )
        .when(missing("visitor"), required("anonymous_id"))
        .when(missing("at"), required("occurred_at"))
        .when(
            f["instant"].isNull(),
            F.concat(F.lit("occurred_at is not ISO-8601: "), quoted(f["at"])),
        )
        .when(
            name.isin(WITH_PRODUCT) & ~_given(f["product"], f["product_type"]),
            F.concat(name, needs),
        )
        .when(
            name.isin(WITH_ORDER) & ~_given(f["order"], f["order_type"]),
            "purchase requires order.order_id",
        )
        .when(
            name.isin(WITH_ORDER) & ~owed,
            F.concat(F.lit("purchase requires a non-negative order.revenue_usd, got "), shown),
        )
    )


def valid_events(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error").isNull()).drop("error", "message_key", "message_value")


def clean_text(raw: Column, limit: int | None = None) -> Column:
    """Bytes as storable text: bad UTF-8 replaced, NUL shown as \\x00; whole unless `limit` is set."""
    text = F.make_valid_utf8(raw.cast("string"))
    shown = F.replace(text, F.char(F.lit(0)), F.lit("\\x00"))
    return shown if limit is None else F.substring(shown, 1, limit)


def dead_letters(
    validated: DataFrame, key_limit: int | None = None, value_limit: int | None = None
) -> DataFrame:
    """Rejected messages of a batch with their reason and cleaned text, whole by default."""
    place = F.concat_ws("/", *ENVELOPE)
    return validated.where(F.col("error").isNotNull()).select(
        F.md5(place).alias("dead_letter_id"),
        "batch_id",
        *ENVELOPE,
        clean_text(F.col("message_key"), key_limit).alias("message_key"),
        clean_text(F.col("message_value"), value_limit).alias("message_value"),
        "error",
    )


def _place() -> Column:
    """A number that orders the copies of a message by offset, then partition."""
    offset = F.col("kafka_offset").cast("decimal(20,0)")
    return offset * F.lit(1 << 31).cast("decimal(11,0)") + F.col("kafka_partition")


def first_offset(events: DataFrame) -> DataFrame:
    """One row per event_id: the copy with the lowest offset (then partition).

    Ids that came more than once are found from numbers alone; a row is dropped if its id is among
    them and its place is not the first. Where they are few, as is usual, no payload is shuffled,
    and a message delivered a billion times is no hot partition. `events` is read more than once,
    so store or persist what is dear to compute. Copies with the same offset and partition, as in
    several topics, are told apart by a hash of the row.
    """
    placed = events.groupBy("event_id", _place().alias("_place")).agg(F.count(F.lit(1)).alias("n"))
    # the last bit tells whether several copies have that place
    marked = F.col("_place") * 2 + (F.col("n") > 1).cast("int")
    repeated = (
        placed.groupBy("event_id")
        .agg(F.sum("n").alias("n"), F.min(marked).alias("_first"))
        .where("n > 1")
        .select("event_id", "_first", (F.col("_first") % 2 == 1).alias("_tied"))
    )
    is_first = _place() * 2 + F.col("_tied").cast("int") == F.col("_first")
    single = events.join(repeated, "event_id", "left").where(
        F.col("_first").isNull() | (~F.col("_tied") & is_first)
    )
    rest = [c for c in events.columns if c != "event_id"]
    ties = (
        events.join(repeated.where("_tied"), "event_id")
        .where(is_first)
        .groupBy("event_id")
        .agg(F.min_by(F.struct(*rest), F.xxhash64(*events.columns)).alias("first"))
        .select(*[c if c == "event_id" else F.col(f"first.{c}").alias(c) for c in events.columns])
    )
    return single.select(*events.columns).union(ties)


def unseen(events: DataFrame, landed: DataFrame) -> DataFrame:
    """Events whose id has not landed yet; the first writer wins, nothing is updated."""
    return events.join(landed.select("event_id"), "event_id", "left_anti")


def max_offset_per_partition(messages: DataFrame) -> DataFrame:
    """Highest offset read per partition; reading resumes at the next one."""
    return messages.groupBy("kafka_topic", "kafka_partition").agg(
        F.max("kafka_offset").alias("max_offset"),
        (F.max("kafka_offset") + 1).alias("resume_offset"),
    )


def ingest_batch_stats(validated: DataFrame, landed: DataFrame) -> DataFrame:
    """Per batch_id: messages read, inserted, duplicate and rejected, offsets per partition.

    `landed` holds the rows stored so far, each with the batch that stored it. The
    map has one entry per partition of the log.
    """
    partitions = validated.groupBy("batch_id", "kafka_topic", "kafka_partition").agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("error").isNull()).alias("valid"),
        F.max("kafka_offset").alias("offset"),
    )
    entries = F.array_sort(F.collect_list(F.struct("kafka_partition", "offset")))
    batches = partitions.groupBy("batch_id", F.col("kafka_topic").alias("topic")).agg(
        F.sum("messages").alias("messages_read"),
        F.sum("valid").alias("_valid"),
        F.map_from_entries(entries).alias("offsets"),
    )
    stored = landed.groupBy("batch_id").agg(F.count("*").alias("_stored"))
    inserted = F.coalesce(F.col("_stored"), F.lit(0))
    return batches.join(stored, "batch_id", "left").select(
        "batch_id",
        "topic",
        "messages_read",
        inserted.alias("rows_inserted"),
        (F.col("_valid") - inserted).alias("rows_duplicate"),
        (F.col("messages_read") - F.col("_valid")).alias("rows_rejected"),
        "offsets",
    )
