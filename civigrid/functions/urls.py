"""URL expressions: three normal forms for comparison, and what a map service's address says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civigrid.functions.text import blank, let, title_text, trimmed

SPECIAL = r"(?i)^(https?|ftp|wss?):"
OTHER = r"(?i)^([a-z][a-z0-9+.-]*):([^?#]*)"
ADDRESS = r"(?i)^([a-z]+):/*(?:([^/?#]*)@)?([^/?#@:]*|\[[0-9a-f:.]+\])(?::([0-9]*))?(/[^?#]*)?(?:[?#].*)?$"
DOTTED = r"(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})"
SERVICE = r"(?i)/(FeatureServer|MapServer)(?:/|$)"
# The ports that schemes have unless told otherwise.
PORTS = {"http": "80", "https": "443", "ws": "80", "wss": "443", "ftp": "21"}


def _cleaned(url: Column) -> Column:
    """As a URL is read: without white space and control characters around, or tabs and line ends inside; backslashes are slashes in known schemes."""
    u = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")
    head, tail = F.regexp_extract(u, r"^([^?#]*)", 1), F.regexp_extract(u, r"^[^?#]*(.*)$", 1)
    return F.when(u.rlike(SPECIAL), F.concat(F.translate(head, "\\", "/"), tail)).otherwise(u)


def _host(raw: Column) -> Column:
    """A host in lower case, percent-decoded, international names in their ASCII form, numbers as addresses; null for one that can't be a host."""
    decoded = F.when(F.contains(raw, F.lit("%")), F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)

    def settled(name: Column) -> Column:
        numbered = name.rlike(r"(?:^|\.)(?:[0-9]+|0x[0-9a-f]*)\.?$")
        fine = (name != "") & ~name.rlike(r"[\x00-\x20#%/:<>?@\[\]\\^|\x7F]")
        return F.when(name.rlike(r"^\[[0-9a-f:.]+\]$"), ipv6(F.regexp_replace(name, r"[\[\]]", ""))).when(fine & numbered, ipv4(name)).when(fine, name)

    return let(decoded, lambda d: let(F.when(d.rlike(r"[^\x00-\x7F]|(?i)xn--"), ascii_name(d)).otherwise(F.lower(d)), settled))


# Letters that names keep although lower-casing and compatibility forms would change or drop them (sharp s,
# final sigma, the two joiners), and rare letters of the Latin script that stand for them meanwhile.
KEPT, STAND_INS = "\u00df\u03c2\u200d\u200c", "\u1e9f\ua765\ua787\ua77a"


def ascii_name(name: Column) -> Column:
    """An international name in its ASCII form: each label that isn't ASCII by Punycode; null for one that can't be.

    Labels are put in lower case and in compatibility form by the JVM, other full stops become dots, and labels that are
    in ASCII form already must be such forms.
    """
    def mapped(f: str, x: Column) -> Column:
        return F.call_function("try_reflect", F.lit("java.net.IDN"), F.lit(f), x, F.lit(1))

    low = F.translate(F.lower(name), KEPT, STAND_INS)
    plain = F.translate(mapped("toUnicode", mapped("toASCII", F.coalesce(low, F.lit("x")))), STAND_INS, KEPT)
    labels = F.transform(F.split(plain, r"\."), lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), F.concat(F.lit("xn--"), punycode(x))).when(~x.startswith("xn--"), x))
    return let(labels, lambda x: F.when(~F.exists(x, lambda y: y.isNull()), F.array_join(x, ".")))


def punycode(label: Column) -> Column:
    """The Punycode of a label (RFC 3492): its ASCII letters, then where the others go in, smallest first."""
    def number(x: int) -> Column:
        return F.lit(x).cast("long")

    def digit(v: Column) -> Column:
        return F.char(F.when(v < 26, v + 97).otherwise(v + 22))

    def digits(delta: Column, bias: Column) -> Column:
        """A number of variable length, as digits whose weights follow from the bias."""
        def write(q: Column, k: Column) -> Column:
            t = F.least(number(26), F.greatest(number(1), k - bias))
            more = F.struct(F.floor((q["q"] - t) / (36 - t)).alias("q"), F.lit(False).alias("over"), F.concat(q["out"], digit(t + F.pmod(q["q"] - t, 36 - t))).alias("out"))
            return F.when(q["over"], q).when(q["q"] >= t, more).otherwise(F.struct(q["q"].alias("q"), F.lit(True).alias("over"), F.concat(q["out"], digit(q["q"])).alias("out")))

        return F.aggregate(F.sequence(number(36), number(432), number(36)), F.struct(delta.alias("q"), F.lit(False).alias("over"), F.lit("").alias("out")), write)["out"]

    def adapted(spread: Column) -> Column:
        less = F.aggregate(F.sequence(number(0), number(6)), F.struct(spread.alias("d"), number(0).alias("k")), lambda a, _: F.when(a["d"] > 455, F.struct(F.floor(a["d"] / 35).alias("d"), (a["k"] + 36).alias("k"))).otherwise(a))
        return let(less, lambda a: a["k"] + F.floor(36 * a["d"] / (a["d"] + 38)))

    def of(places: Column) -> Column:
        basic = F.filter(places, lambda p: p["c"] < 128)
        start = F.struct(number(128).alias("n"), number(0).alias("at"), F.size(basic).cast("long").alias("h"), number(72).alias("bias"), F.lit("").alias("out"), F.lit(True).alias("first"))

        def step(s: Column, p: Column) -> Column:
            into = F.size(F.filter(places, lambda o: (o["i"] < p["i"]) & (o["c"] <= p["c"]))).cast("long")

            def inserted(m: Column) -> Column:
                damped = F.floor(m["delta"] / F.when(s["first"], number(700)).otherwise(number(2)))
                bias = let(damped, lambda d: adapted(d + F.floor(d / (s["h"] + 1))))
                return F.struct(p["c"].alias("n"), (m["into"] + 1).alias("at"), (s["h"] + 1).alias("h"), bias.alias("bias"), F.concat(s["out"], digits(m["delta"], s["bias"])).alias("out"), F.lit(False).alias("first"))

            return let(into, lambda i: let(F.struct(i.alias("into"), ((p["c"] - s["n"]) * (s["h"] + 1) + i - s["at"]).alias("delta")), inserted))

        coded = F.aggregate(F.array_sort(F.filter(places, lambda p: p["c"] >= 128)), start, step)["out"]
        return F.concat(F.array_join(F.transform(basic, lambda p: F.char(p["c"])), ""), F.when(F.size(basic) > 0, "-").otherwise(""), coded)

    return let(F.transform(F.sequence(F.lit(1), F.length(label)), lambda i: F.struct(F.ascii(F.substr(label, i, F.lit(1))).cast("long").alias("c"), i.cast("long").alias("i"))), of)


def ipv4(host: Column) -> Column:
    """A host whose last part is a number, as four numbers: parts are decimal, octal or hexadecimal, the last fills what is left; else null."""
    values = F.transform(F.split(F.regexp_replace(host, r"\.$", ""), r"\."), lambda p: F.when(p.rlike("^0x[0-9a-f]*$"), F.coalesce(F.conv(F.concat(F.lit("0"), F.substr(p, F.lit(3))), 16, 10), F.lit("0"))).when(p.rlike("^0[0-7]+$"), F.conv(p, 8, 10)).when(p.rlike("^(?:0|[1-9][0-9]*)$"), p).try_cast("long"))

    def of(v: Column) -> Column:
        n, last = F.size(v), F.element_at(v, -1)
        others = F.slice(v, F.lit(1), F.greatest(n - 1, F.lit(0)))
        fine = (n <= 4) & ~F.exists(v, lambda x: x.isNull()) & ~F.exists(others, lambda x: x > 255) & (last < F.pow(F.lit(256), 5 - n))
        total = F.aggregate(others, F.struct(last.alias("sum"), F.lit(3).alias("k")), lambda a, x: F.struct((a["sum"] + x * F.pow(F.lit(256), a["k"]).cast("long")).alias("sum"), (a["k"] - 1).alias("k")))["sum"]
        return F.when(fine, let(total, lambda t: F.concat_ws(".", *(F.pmod(F.shiftright(t, 8 * k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)))))

    return let(values, of)


def ipv6(inner: Column) -> Column:
    """An address of the sixth version as it is written: small digits, no zeros in front, the first of the longest runs of zeros left out; else null."""
    def run(k: int) -> str:
        return rf"(?<![0-9a-f])0(?::0){{{k - 1}}}(?![0-9a-f])"

    def shortened(line: Column) -> Column:
        cut = line
        for k in range(2, 9):
            cut = F.when(line.rlike(run(k)), F.regexp_replace(F.regexp_replace(line, "^(.*?)" + run(k), "$1::"), ":{3,}", "::")).otherwise(cut)
        return F.concat(F.lit("["), cut, F.lit("]"))

    def half(halves: Column, k: int) -> Column:
        return F.when(F.coalesce(F.get(halves, F.lit(k)), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(F.get(halves, F.lit(k)), ":", -1))

    def of(h: Column) -> Column:
        """From a struct of the pieces on both sides, and the number of sides."""
        filled = 8 - F.size(h["a"]) - F.size(h["b"])
        fine = F.when(h["n"] == 2, filled >= 1).otherwise((h["n"] == 1) & (filled == 0))
        whole = F.concat(h["a"], F.array_repeat(F.lit("0"), F.greatest(filled, F.lit(0))), h["b"])
        return F.when(fine & F.forall(whole, lambda p: p.rlike("^[0-9a-f]{1,4}$")), let(F.array_join(F.transform(whole, lambda p: F.regexp_replace(p, "^0+(?=.)", "")), ":"), shortened))

    def without_dots(four: Column) -> Column:
        two = F.concat_ws(":", *(F.lower(F.hex(F.get(four, F.lit(k)) * 256 + F.get(four, F.lit(k + 1)))) for k in (0, 2)))
        return F.when(F.size(four) < 4, inner).when(F.forall(four, lambda v: v < 256), F.concat(F.regexp_replace(inner, f"{DOTTED}$", ""), two))

    four = F.transform(F.split(F.regexp_extract(inner, f":({DOTTED})$", 1), r"\."), lambda p: p.try_cast("int"))
    halves = F.split(let(four, without_dots), "::", -1)
    return let(halves, lambda h: let(F.struct(half(h, 0).alias("a"), half(h, 1).alias("b"), F.size(h).alias("n")), of))


def _user(raw: Column) -> Column:
    """What stands before a host: a name and perhaps a password, in which further @ and : are percent-encoded."""
    name, word = F.regexp_extract(raw, "^([^:]*)", 1), F.regexp_extract(raw, "^[^:]*:(.*)$", 1)
    coded = F.replace(F.concat(name, F.when(word != "", F.concat(F.lit(":"), F.replace(word, F.lit(":"), F.lit("%3A")))).otherwise("")), F.lit("@"), F.lit("%40"))
    return F.when(coded == "", "").otherwise(F.concat(coded, F.lit("@")))


def _path(raw: Column) -> Column:
    """A path without dot segments, with what may not stand in it percent-encoded."""
    unsafe = r"[\x00-\x20\"<>^`{}\x7F]|[^\x00-\x7F]"
    one, two = r"(?i)^(?:\.|%2e)$", r"(?i)^(?:\.|%2e){2}$"

    def step(done: Column, part: Column) -> Column:
        return F.when(part.rlike(two), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(part.rlike(one), done).otherwise(F.concat(done, F.array(part)))

    def coded(raw: Column) -> Column:
        letters = F.transform(F.split(raw, ""), lambda c: F.when(c.rlike(unsafe), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c))
        return F.when(raw.rlike(unsafe), F.array_join(letters, "")).otherwise(raw)

    def settled(parts: Column) -> Column:
        kept = F.aggregate(parts, F.array().cast("array<string>"), step)
        last = F.element_at(parts, -1)
        return F.concat(F.lit("/"), F.array_join(F.when(last.rlike(one) | last.rlike(two), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))

    def plain(c: Column) -> Column:
        return F.when(c.rlike(r"(?i)(?:^|/)(?:\.|%2e){1,2}(?:/|$)"), let(F.split(F.regexp_replace(c, "^/", ""), "/"), settled)).otherwise(F.when(c == "", "/").otherwise(c))

    return let(let(raw, coded), plain)


def _plain(url: Column) -> Column:
    """A URL as its parser writes it, without query and fragment: scheme and host in lower case, no default port, a clean path; null if it doesn't parse.

    Other schemes keep what follows them.
    """
    return let(_cleaned(url), _written)


def _written(u: Column) -> Column:
    """``_plain`` of a URL that has been cleaned."""
    usual = F.create_map(*(F.lit(x) for pair in PORTS.items() for x in pair))
    scheme, user, host, port, path = (F.regexp_extract(u, ADDRESS, i) for i in range(1, 6))

    def joined(p: Column) -> Column:
        own_port = F.when((p["number"] == "") | (p["number"] == F.try_element_at(usual, p["low"])), "").otherwise(F.concat(F.lit(":"), p["number"]))
        # Ports are compared as digits: a cast costs an exception for each text without a number.
        fine = (F.length(p["number"]) < 6) & (F.lpad(p["number"], 5, "0") < "65536")
        return F.when(fine, F.concat(p["low"], F.lit("://"), F.when(p["user"] == "", "").otherwise(_user(p["user"])), _host(p["host"]), own_port, _path(p["path"])))

    special = F.when(u.rlike(ADDRESS), let(F.struct(F.lower(scheme).alias("low"), user.alias("user"), host.alias("host"), F.regexp_replace(port, "^0+(?=[0-9])", "").alias("number"), path.alias("path")), joined))
    other = F.when(u.rlike(OTHER), F.concat(F.lower(F.regexp_extract(u, OTHER, 1)), F.lit(":"), F.regexp_extract(u, OTHER, 2)))
    return F.when(u.rlike(SPECIAL), special).otherwise(other)


def lookup_key(url: Column) -> Column:
    """For joining search hits: no query or fragment, no trailing slashes, all lower case; else trimmed, the same."""
    return F.lower(F.regexp_replace(F.coalesce(_plain(url), trimmed(url)), "/+$", ""))


def layer_key(url: Column) -> Column:
    """For comparing layers: no query or fragment, one trailing slash less, the path's case kept; else the text's words."""
    return F.coalesce(F.regexp_replace(_plain(url), "/$", ""), title_text(url))


def request_key(url: Column) -> Column:
    """For requesting metadata: trimmed, without trailing slashes; a query stays."""
    return F.regexp_replace(trimmed(url), "/+$", "")


def service_type(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, SERVICE, 1))
    return F.when(found == "featureserver", "FeatureServer").when(found == "mapserver", "MapServer").otherwise("unknown")


def is_layer(url: Column) -> Column:
    return F.coalesce(url.rlike(r"(?i)/(FeatureServer|MapServer)/\d+$"), F.lit(False))


def service_root(url: Column) -> Column:
    """The service of a layer's address."""
    return F.regexp_replace(url, r"(?i)(/(?:FeatureServer|MapServer))/\d+$", "$1")


def service_name(url: Column) -> Column:
    return blank(F.regexp_extract(service_root(url), r"(?i)/([^/]+)/(?:FeatureServer|MapServer)$", 1))


def layer_name(url: Column) -> Column:
    n = F.regexp_extract(url, r"(?i)/(?:FeatureServer|MapServer)/(\d+)$", 1)
    return F.when(n != "", F.concat(F.lit("Layer "), n))


def metadata_url(url: Column) -> Column:
    """The address that gives a layer's or service's metadata as JSON."""
    return F.concat(url, F.when(F.contains(url, F.lit("?")), "&f=json").otherwise("?f=json"))


def is_http(url: Column) -> Column:
    """Whether a text parses as a URL of these schemes."""
    return F.coalesce(_plain(url).rlike("^https?:"), F.lit(False))


# Spellings of geometry types and the names that are kept.
GEOMETRIES = ["esriGeometryPoint", "esriGeometryMultipoint", "esriGeometryPolyline", "esriGeometryPolygon", "esriGeometryEnvelope", "point", "multipoint", "polyline", "polygon"]


def geometry_type(c: Column) -> Column:
    """A geometry type's canonical spelling, "unknown" for others, null for null and ''."""
    names = F.create_map(*(F.lit(x) for g in GEOMETRIES for x in (g.lower(), g)))
    return F.when(blank(c).isNotNull(), F.coalesce(F.try_element_at(names, F.lower(trimmed(c))), F.lit("unknown")))


def plain_geometry(c: Column) -> Column:
    """A geometry type without its vendor's prefix; other values by their words; null for null and ''."""
    short = {g: g.removeprefix("esriGeometry").lower() for g in GEOMETRIES}
    names = F.create_map(*(F.lit(x) for k, v in short.items() for x in (k, v)))
    return F.when(blank(c).isNotNull(), F.coalesce(F.try_element_at(names, c), title_text(c)))
