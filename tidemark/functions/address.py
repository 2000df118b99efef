"""Relay addresses: parsing, showing, and what path a session asks for, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(url: Column) -> Column:
    """struct(origin, host, port, path, query, fragment); port is null where it is none, host where there is none.

    The scheme may be left out. '#', '?' and '/' are cut at in that order; the port is 443 unless named.
    """
    g = lambda i: F.regexp_extract(url, r"(?s)^((?:.*?://)?)([^/?#]*)(?:/([^?#]*))?(?:\?([^#]*))?(?:#(.*))?$", i)
    authority = g(2)
    ported = authority.rlike(r"^.+:[^\]]*$")
    name = F.when(ported, F.regexp_extract(authority, r"^(.+):([^\]:]*)$", 1)).otherwise(authority)
    port = F.when(ported, F.regexp_extract(authority, r"^(.+):([^\]:]*)$", 2)).otherwise(F.lit("443"))
    number = F.when(port.rlike("^[+]?[0-9]{1,9}$") & port.try_cast("int").between(0, 65535), port.try_cast("int"))
    host = F.regexp_replace(F.regexp_replace(name, r"^\[+", ""), r"\]+$", "")
    return F.struct(
        F.concat(g(1), authority).alias("origin"), F.when(host != "", host).alias("host"), number.alias("port"), g(3).alias("path"), g(4).alias("query"), g(5).alias("fragment"),
    )


def shown(p: Column) -> Column:
    """The origin, and a mark for each part that is there: credentials are never shown."""
    mark = lambda c, m: F.when(p[c] != "", m + "...").otherwise("")
    return F.concat(p["origin"], mark("path", "/"), mark("query", "?"), mark("fragment", "#"))


def shorten(token: Column) -> Column:
    n = F.char_length(token)
    return F.when(n <= 12, F.concat(n.cast("string"), F.lit(" characters"))).otherwise(F.concat(F.substring(token, 1, 4), F.lit("..."), F.right(token, F.lit(4))))


def url_token(p: Column) -> Column:
    """The token that the URL carries: a jwt parameter with a value, else the path."""
    pairs = F.filter(F.split(p["query"], "&"), lambda x: x.rlike("^jwt=.+"))
    return F.coalesce(F.substring(F.try_element_at(pairs, F.lit(1)), F.lit(5), F.length(p["query"])), p["path"])


def refusal(p: Column, token: Column) -> Column:
    """Why no session is opened, or null."""
    return (
        F.when(p["host"].isNull(), "no host").when(p["port"].isNull(), "not a port").when(p["fragment"] != "", "fragment")
        .when(F.exists(F.split(p["query"], "&"), lambda x: F.lower(F.split_part(x, F.lit("="), F.lit(1))) == "token"), "token parameter")
        .when((token != "") & (url_token(p) != "") & (url_token(p) != token), "two tokens")
    )


def session_path(p: Column, token: Column) -> Column:
    """What the session asks the relay for; null where it is refused."""
    bare = (p["path"] == "") & (p["query"] == "")
    path = F.concat(F.lit("/"), p["path"], F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""))
    own = F.when(bare, F.when(token == "", "").otherwise(F.concat(F.lit("/"), token))).otherwise(path)
    return F.when(refusal(p, token).isNull(), own)


def session_path_or_fail(url: Column, token: Column) -> Column:
    p = parts(url)
    why = refusal(p, token)
    return F.when(why.isNull(), session_path(p, token)).otherwise(F.raise_error(F.concat(F.lit("relay '"), shown(p), F.lit("': "), why)).cast("string"))
