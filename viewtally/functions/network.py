"""IPv4 addresses as numbers and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .scalars import column, label_of

_IPV4 = r"^\s*\d{1,3}(\.\d{1,3}){3}\s*$"


def _octet(ip: Column, i: int) -> Column:
    return F.get(F.split(F.trim(ip), r"\."), F.lit(i)).try_cast("bigint")


def ip_number(ip) -> Column:
    """The address as a number, null if it is none."""
    ip = column(ip)
    o = [_octet(ip, i) for i in range(4)]
    return F.when(ip.rlike(_IPV4), ((o[0] * 256 + o[1]) * 256 + o[2]) * 256 + o[3])


def network_key(ip) -> Column:
    """Number of the /24 network, the key of the location table; bad IP -> 0."""
    number = ip_number(ip)
    return F.coalesce(number - F.pmod(number, F.lit(256)), F.lit(0).cast("bigint"))


def padded_ip(ip) -> Column:
    """Zero-padded octets: text order equals number order."""
    return F.array_join(F.transform(F.split(F.trim(column(ip)), r"\."), lambda o: F.lpad(o, 3, "0")), ".")


def client_ip(forwarded, remote) -> Column:
    """First address of the forwarded list, else the remote address."""
    first = F.trim(F.split(column(forwarded), ",")[0])
    return F.coalesce(F.nullif(first, F.lit("")), column(remote))


def full_province(province) -> Column:
    """Complete a cut province name; null -> unknown."""
    province = column(province)
    return F.when(province.isNull(), F.lit(V.UNKNOWN)).otherwise(label_of(province, V.PROVINCE_FIXES, province))


def home_province(province) -> Column:
    """The province if it is one of the home country, else 'abroad and other'."""
    province = column(province)
    return F.when(province.isin(V.PROVINCES), province).otherwise(F.lit(V.ABROAD_LABEL))
