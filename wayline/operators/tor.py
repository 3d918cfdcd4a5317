"""Tor relay flags from two address lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.functions.ip import ip_to_int
from wayline.operators.sizing import hinted, is_small

# Labels.
INVALID, EXIT, SERVER, NEITHER = "Invalid IP", "TOR Exit Node", "TOR Server", "None"


def relay_table(exit_nodes: DataFrame, servers: DataFrame) -> DataFrame:
    """Both address sets (column ``ip_int``) as one row per address with two flags."""
    both = exit_nodes.select("ip_int", F.lit(True).alias("is_exit"), F.lit(False).alias("is_server")).unionByName(
        servers.select("ip_int", F.lit(False).alias("is_exit"), F.lit(True).alias("is_server"))
    )
    return both.groupBy("ip_int").agg(F.max("is_exit").alias("is_exit"), F.max("is_server").alias("is_server"))


def missing_servers(exit_nodes: DataFrame, servers: DataFrame) -> DataFrame:
    """Exit nodes that the server list lacks."""
    return exit_nodes.join(servers, "ip_int", "left_anti")


def tag_relays(
    df: DataFrame, column: str, relays: DataFrame, int_ip: bool = False, small: bool | None = None,
    address: str | None = None,
) -> DataFrame:
    """Add ``tor_info``, ``tor_is_exit_node`` and ``tor_is_tor_server``.

    One join serves both flags. Null and '' are labelled invalid with false flags; text
    that is no address is labelled invalid with null flags. ``address`` names a column
    that already holds the parsed value.
    """
    text = F.col(f"`{column}`").cast("string")
    ip = F.col(address) if address else text.try_cast("bigint") if int_ip else ip_to_int(text)
    side = relays.select(F.col("ip_int").alias("_relay"), "is_exit", "is_server")
    joined = df.withColumn("_ip", ip).join(
        hinted(side, is_small(relays) if small is None else small), F.col("_ip") == F.col("_relay"), "left"
    )
    empty = text.isNull() | (text == "")
    unparsable = ~empty & F.col("_ip").isNull() & F.lit(not int_ip)
    is_exit = F.coalesce(F.col("is_exit"), F.lit(False))
    is_server = F.coalesce(F.col("is_server"), F.lit(False))
    label = F.when(empty | unparsable, INVALID).when(is_exit, EXIT).when(is_server, SERVER).otherwise(NEITHER)
    added = {
        "tor_info": label,
        "tor_is_exit_node": F.when(~unparsable, is_exit),
        "tor_is_tor_server": F.when(~unparsable, is_server),
    }
    kept = [added.pop(c).alias(c) if c in added else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*kept, *[value.alias(name) for name, value in added.items()])
