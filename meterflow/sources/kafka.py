"""Message streams from Kafka topics (needs the Kafka connector on the cluster)."""

from ..checks import require_choice

STARTS = ("earliest", "latest")


def kafka_options(servers, topic, start="earliest", max_per_trigger=None,
                  fail_on_data_loss=True, group_id=None):
    """Reader options. ``start=None`` leaves the source's own default.

    Defaults lose nothing: a first start reads from the beginning, and missing
    offsets stop the query unless ``fail_on_data_loss`` is switched off. Nothing
    is throttled unless ``max_per_trigger`` says so; with a 10-second trigger
    500 messages a batch are at most 50 a second.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start is not None:
        if not start.lstrip().startswith("{"):  # per-partition offsets are JSON
            require_choice("start", start, STARTS)
        options["startingOffsets"] = start
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(int(max_per_trigger))
    options["failOnDataLoss"] = "true" if fail_on_data_loss else "false"
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def kafka_stream(spark, servers, topic, **options):
    """Streaming messages of one topic, with the text or JSON bytes in ``value``."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def kafka_table(spark, servers, topic, start="earliest", end="latest", **options):
    """The same messages as a bounded table, for backfills."""
    chosen = kafka_options(servers, topic, start=start, max_per_trigger=None, **options)
    return spark.read.format("kafka").options(endingOffsets=end, **chosen).load()
