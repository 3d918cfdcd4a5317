"""IPv4 codecs and CIDR tests as Column expressions over BIGINT addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_IP = 4294967295

# The C library's address grammar. One to four parts separated by
# dots; each part is decimal, octal (leading 0) or hexadecimal (leading 0x).
_PART = r"(?:0[xX][0-9a-fA-F]+|0[0-7]*|[1-9][0-9]*)"
_ADDRESS = rf"^{_PART}(?:\.{_PART}){{0,3}}\z"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED_QUAD = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"
# Text after the first of these blanks is ignored by the C library.
_BLANKS = r"[ \t\n\x0B\f\r]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _left(c: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", c, bits.cast("int"))


def _right(c: Column, bits: Column) -> Column:
    return F.call_function("shiftright", c, bits.cast("int"))


def _quad_value(text: Column) -> Column:
    """Value of a plain dotted quad. Nothing is conditional but the last term, so Spark
    splits the text once."""
    parts = F.split(text, r"\.")
    p = [F.get(parts, F.lit(i)).try_cast("smallint").cast("bigint") for i in range(4)]
    valid = F.when(text.rlike(_DOTTED_QUAD), F.lit(0).cast("bigint"))
    return p[0] * 16777216 + p[1] * 65536 + p[2] * 256 + p[3] + valid


def _part_value(part: Column) -> Column:
    base = F.when(part.rlike("^0[xX]"), 16).when(part.startswith("0"), 8).otherwise(10)
    digits = F.regexp_replace(part, "^(?:0[xX])?0*(?=.)", "")
    # Eleven octal digits hold 32 bits; longer text is out of range in any base.
    return F.when(F.length(digits) <= 11, F.call_function("conv", digits, base, F.lit(10)).try_cast("bigint"))


def _weighted(values: Column) -> Column:
    """Leading parts are one byte each, the last one fills the remaining bytes."""
    n = F.size(values)
    last = F.element_at(values, -1)
    leading = F.slice(values, F.lit(1), n - 1)
    room = _left(F.lit(1).cast("bigint"), F.lit(40) - n * 8)
    head = F.aggregate(leading, F.lit(0).cast("bigint"), lambda total, byte: total * 256 + byte)
    fits = F.forall(leading, lambda byte: byte < 256) & (last < room)
    return F.when(fits, head * room + last)


def _general_value(text: Column) -> Column:
    head = F.get(F.split(text, _BLANKS, 2), F.lit(0))
    values = F.transform(F.split(F.when(head.rlike(_ADDRESS), head), r"\."), _part_value)
    return F.get(F.transform(F.array(values), _weighted), F.lit(0))


def ip_to_int(ip: Column | str, strict: bool = False) -> Column:
    """Address text to an unsigned 32-bit value held in a BIGINT; null when unparsable.

    ``strict`` accepts plain dotted quads only. Otherwise the C library's whole
    grammar is accepted: short forms, octal and hex parts, trailing text after a
    blank. That part only runs for text that is no plain dotted quad.
    """
    text = _col(ip).cast("string")
    quad = _quad_value(text)
    return quad if strict else F.coalesce(quad, _general_value(text))


def int_to_ip(value: Column | str) -> Column:
    """Unsigned 32-bit value to dotted text; null outside 0..2^32-1."""
    v = _col(value).cast("bigint")
    octets = [F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.when(v.between(0, MAX_IP), F.concat_ws(".", *octets))


def prefix_mask(length: Column) -> Column:
    """Network mask of a prefix length as BIGINT."""
    full = F.lit(MAX_IP).cast("bigint")
    return _left(full, F.lit(32) - length).bitwiseAND(full)


def network_address(cidr: Column | str) -> Column:
    """Address part of ``a.b.c.d/len`` as BIGINT, host bits included."""
    return ip_to_int(F.get(F.split(_col(cidr), "/"), F.lit(0)))


def prefix_length(cidr: Column | str) -> Column:
    """Prefix length of ``a.b.c.d/len``; null unless it is 0..32."""
    length = F.get(F.split(_col(cidr), "/"), F.lit(1)).try_cast("int")
    return F.when(length.between(0, 32), length)


def in_network(ip_int: Column | str, cidr: Column | str) -> Column:
    """True when the address lies in the network.

    A network with host bits set contains nothing: the masked address is compared
    with the network text as written.
    """
    net = cidr if isinstance(cidr, Column) else F.lit(cidr)
    masked = _col(ip_int).cast("bigint").bitwiseAND(prefix_mask(prefix_length(net)))
    return masked == network_address(net)
