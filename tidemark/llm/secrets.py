"""Secret scans: pattern candidates, judged by a random forest. DataFrame functions only.

Candidates are long runs of key characters that hold a digit, known key
formats, and values assigned to a name like `token` or `secret_key` or following
`Bearer`. The forest
weighs length, character transitions, how much of the candidate dictionary
words cover, whether it looks like or stands in a path, and the words beside
it, so that hashes, identifiers, file names and placeholders are left alone.
It is trained on labelled findings (before, candidate, after, label), by
default a generated set of them; at most `train_rows` take part.

Training collects the findings' features; the trees become SQL expressions, so
scoring stays in the JVM. Nothing here is a Python UDF.

Defined results
* one row for each occurrence of a candidate, numbered in its text; equal
  candidates may score differently, as what stands beside them differs;
* a null or empty text has no findings; neither has an empty table; a text of any length is searched whole;
* repeated document rows each give their findings; further columns are ignored
  by `findings` and kept by `redacted`;
* without labelled findings (an empty table) every candidate counts as a secret.
"""

from __future__ import annotations

import json
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import project

# Public key formats, and words that speak for or against a secret.
FORMATS = [
    ("aws_access_key", r"(?:AKIA|ASIA)[0-9A-Z]{16}"),
    ("github_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("stripe_key", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    ("google_key", r"AIza[A-Za-z0-9_-]{35}"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}"),
]
FOR = ["token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "accesskey", "auth", "bearer", "credential", "private", "key"]
AGAINST = ["sha", "sha1", "sha256", "md5", "commit", "checksum", "digest", "revision", "rev", "uuid", "guid", "hash", "etag", "version", "isbn", "phone", "order", "invoice", "example", "sample", "dummy", "placeholder", "test", "fake"]
DICTIONARY = [
    "password", "example", "placeholder", "changeme", "secret", "token", "dummy", "sample", "config", "default", "application", "service", "server", "client", "database",
    "production", "development", "environment", "version", "release", "document", "image", "video", "download", "upload", "index", "button", "content", "header", "footer",
    "module", "package", "library", "include", "function", "class", "method", "object", "string", "number", "value", "account", "address", "message", "customer",
    "project", "report", "static", "assets", "public", "private", "windows", "linux", "system", "network", "manager", "handler", "controller", "component", "template",
    "your", "user", "name", "test", "data", "file", "path", "home", "page", "with", "from", "this", "that", "here", "insert", "replace", "event", "state", "time", "date", "type", "list", "item", "key",
]
#: What may hold a secret: a value given to a telling name, and a long run with a digit in it.
#: The names are those of FOR in any case, with an ending (secret_key, tokenId, password_hash); a bearer's value needs no sign.
#: A value that holds a known format is left to it. Blanks are named one by one: \s is not the same everywhere.
NAME = "(?i:" + "|".join(sorted(FOR, key=len, reverse=True)) + ")(?:s|(?i:orization))?(?:[_-][A-Za-z0-9]+|[A-Z0-9][a-z0-9]*){0,6}"
LEAD = "(?:" + NAME + r"[\"']?[ \t]*[=:][ \t]*|(?i:bearer)[ \t]+)[\"']?"
VALUE = r"[^ \t\n\x0B\f\r\"'<>,;]"
RUN = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{20,}+={0,2}"
CANDIDATE = "|".join([*(p for _, p in FORMATS), LEAD + "(?!" + VALUE + "*?(?:" + "|".join(p for _, p in FORMATS) + "))" + VALUE + "{8,}+", RUN])
#: Characters beside a candidate that are looked at.
BESIDE = 48
FEATURES = [
    "length", "digits", "upper", "lower", "symbols", "distinct", "switches", "vowel_pairs", "consonant_runs", "hex", "hex_length", "covered", "longest_letters",
    "slashes", "dots", "extension", "path_before", "after_path", "uuid", "format", "repeat", "ascending", "for_before", "against_before", "assigned", "quoted", "against_after", "words_inside",
]


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def feature_columns(before: Column, cand: Column, after: Column) -> list[Column]:
    """The features of a candidate and what stands beside it, in the order of FEATURES."""
    n = F.greatest(F.length(cand), F.lit(1)).cast("double")
    share = lambda pattern: count_of(cand, pattern) / n
    word = lambda ws: r"(?i)(?<![a-z])(?:" + "|".join(ws) + r")(?![a-z0-9])"
    low = F.lower(cand)
    is_ = lambda c: c.cast("double")
    longest = lambda p: F.coalesce(F.array_max(F.transform(F.regexp_extract_all(cand, F.lit(p), F.lit(0)), F.length)), F.lit(0)).cast("double")
    return [
        n, share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[^A-Za-z0-9]"),
        F.size(F.array_distinct(F.split(cand, ""))).cast("double") / n,
        (count_of(cand, "[a-z](?=[0-9])") + count_of(cand, "[0-9](?=[a-zA-Z])") + count_of(cand, "[A-Z](?=[0-9])") + count_of(cand, "[a-z](?=[A-Z])") + count_of(cand, "[A-Z](?=[a-z])")) / n,
        count_of(low, "[aeiou](?=[^aeiou0-9])") / n, count_of(low, "[bcdfghjklmnpqrstvwxz]{3}") / n,
        is_(low.rlike("^[0-9a-f]+$")), F.when(low.rlike("^[0-9a-f]+$"), n).otherwise(0.0),
        (n - F.length(F.regexp_replace(low, "|".join(DICTIONARY), ""))) / n, longest("[A-Za-z]+"),
        count_of(cand, "/"), count_of(cand, r"[.]"), is_(low.rlike(r"[.](?:html?|js|css|png|jpe?g|gif|py|java|txt|json|xml|pdf|md|c|h|go|rs)$")),
        is_(before.rlike(r"(?:[/\\~]|https?:|www[.])\S*$")), is_(after.rlike(r"^[/\\.][A-Za-z0-9]")),
        is_(low.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")),
        is_(cand.rlike("^(?:" + "|".join(p for _, p in FORMATS) + ")")),
        is_(low.rlike(r"(.)\1{4,}|(.{2,4})\2{3,}")), is_(low.rlike("01234567|12345678|abcdefgh|deadbeef|87654321|qwerty")),
        is_(before.rlike(word(FOR) + r"(?:[_-][A-Za-z0-9]+){0,6}[^A-Za-z0-9]{0,12}$")), is_(before.rlike(word(AGAINST) + r"[^A-Za-z0-9]{0,8}$")),
        is_(before.rlike(r"[=:]\s*[\"']?$|(?i:bearer)\s+[\"']?$")), is_(before.rlike("[\"'`]$")), is_(after.rlike("^[^A-Za-z0-9]{0,4}" + word(AGAINST))),
        count_of(cand, "[_-](?=[A-Za-z]{3,}(?:[_-]|$))"),
    ]


def labelled(spark: SparkSession, rows: int = 3000, seed: int = 5) -> DataFrame:
    """Generated labelled findings (before, candidate, after, label): keys in use, and what is mistaken for them."""
    rng = random.Random(seed)
    of = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    hexes, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    prose = lambda: " ".join(of("aeinorsthl", rng.randint(2, 9)) for _ in range(rng.randint(0, 6)))
    words = lambda n, sep: sep.join(rng.choice(DICTIONARY) for _ in range(n))

    def key() -> str:
        kind = rng.randrange(9)
        body = mixed if rng.random() < 0.7 else rng.choice([hexes + "ABCDEF", mixed + "0123456789" * 6])
        return [
            lambda: of(hexes, rng.choice([32, 40, 40, 48, 64])), lambda: of(mixed, rng.randint(20, 64)), lambda: of(mixed + "+/", rng.choice([40, 44, 64])) + "=" * rng.randrange(3),
            lambda: "AKIA" + of(mixed[:26] + "234567", 16), lambda: "ghp_" + of(body, 36), lambda: "sk_live_" + of(body, 24), lambda: "xoxb-" + of("0123456789", 11) + "-" + of(body, 24),
            lambda: "AIza" + of(body + "_-", 35), lambda: "eyJ" + of(mixed, 20) + ".eyJ" + of(mixed, 30) + "." + of(mixed + "_-", 40),
        ][kind]()

    def chosen() -> str:
        """What people or programs choose: short, with signs, or without digits."""
        body = rng.choice([mixed, mixed[:52]])
        word = lambda: rng.choice([str.title, str.upper, str])(of("bcdfghlmnprstaeiou", rng.randint(4, 7)))
        return [
            lambda: of(mixed + "!$%&*@#?^", rng.randint(8, 19)), lambda: of(body, rng.randint(12, 40)),
            lambda: word() + of("!$%&*@#?^", 1) + of("0123456789", rng.randint(1, 4)) + word(), lambda: rng.choice("SPT") + of("0123456789", 1) + of("cdrstw", 3) + of("!$@#", 1) + word(),
        ][rng.randrange(4)]()

    def used() -> tuple[str, str, str]:
        plain = rng.random() < 0.4
        k = chosen() if plain else key()
        own = k.startswith(("AKIA", "ghp_", "sk_live_", "xoxb-", "AIza", "eyJ"))
        name = rng.choice(FOR[:-1] + [w.upper() for w in FOR[:-1]]) + rng.choice(["", "", "", "_key", "_id", "_hash", "_value"])
        quote = rng.choice(['"', '"', "'", ""])
        lead = rng.choice([f"{name} = {quote}", f"{name}={quote}", f"{name}: {quote}", f'"{name}": "', f"{name}  =  {quote}", "Authorization: Bearer "])
        if own and rng.random() < 0.5:
            quote = rng.choice(["", "", "'", '"'])
            lead = rng.choice(["", " ", "use ", "with ", "= "]) + quote
        return prose() + rng.choice([" ", "\n", " | "]) + lead, k, quote + rng.choice(["", " ", ",", "\n"]) + prose()

    def mistaken() -> tuple[str, str, str]:
        kind, n = rng.randrange(14), str(rng.randint(1, 99))
        lead, cand = [
            lambda: (rng.choice([f"{w} " for w in AGAINST[:12]] + [f"{w}: " for w in AGAINST[:12]]), of(hexes, rng.choice([32, 40, 64]))),
            lambda: ("", of(hexes, 8) + "-" + of(hexes, 4) + "-4" + of(hexes, 3) + "-a" + of(hexes, 3) + "-" + of(hexes, 12)),
            lambda: (rng.choice(["https://host.example/", "/usr/share/", "./", "src/"]), words(rng.randint(2, 5), "/") + n),
            lambda: (rng.choice([" ", "id=", "class: "]), words(rng.randint(3, 5), rng.choice(["_", "-", ""])) + n),
            lambda: (rng.choice(["token = \"", "password: ", "api_key="]), rng.choice(["your_token_here", "your-api-key-goes-here-1", "changeme12345678", "xxxxxxxxxxxxxxxxxxxx1", "placeholder_secret_1", "example-token-0000000", "<insert_key_here>1"])),
            lambda: (rng.choice(["token = \"", "secret: "]), rng.choice(["0" * 20, "1234567890" * 3, "deadbeef" * 5, "abcdefghijklmnopqrstuvwxyz123456", "a1" * 16])),
            lambda: (rng.choice(["", "phone ", "order "]), of("0123456789", rng.randint(20, 30))),
            lambda: (rng.choice(["", " "]), of("aeiou", 1) + "".join(of("bcdfghlmnprst", 1) + of("aeiou", 1) for _ in range(rng.randint(9, 16))) + n),
            lambda: (rng.choice(["https://cdn.example/", "img/"]), of(hexes, 32) + rng.choice(["/", "_small", "-large"]) + "image" + n),
            lambda: (rng.choice(["password = ", "token: "]), rng.choice(["os.environ", "getpass.getpass()", "settings.TOKEN", "request.headers", "None-or-default", "process.env.TOKEN", "${SECRET_TOKEN}"])),
            lambda: (" ", of(mixed[:26], rng.randint(20, 30)).lower() + "_" + words(2, "_") + n),
            lambda: (rng.choice(FOR) + rng.choice([": ", " : ", "="]), rng.choice(["required", "incorrect", "forgotten", "available", "important", "different", "questions", "everything", "authentication", "information", "undefined", "generated", "encrypted"])),
            lambda: (rng.choice(["author: ", "Authors: ", "bearer ", "key: ", "keys: ", "private: ", "Bearer "]), rng.choice([str.title, str, str])("".join(of("bcdfghlmnprst", 1) + of("aeiou", 1) for _ in range(rng.randint(4, 6))) + rng.choice(["", "s", ".", "n"]))),
            lambda: (rng.choice(FOR) + rng.choice(["_id", "_name", ""]) + rng.choice([" = ", ": ", "="]), rng.choice(["self.", "config.", "request.", "get_", "os.", "$"]) + words(rng.randint(1, 2), rng.choice([".", "_"])) + rng.choice(["", "()", "(x)"])),
        ][kind]()
        return prose() + " " + lead, cand, rng.choice(["", " ", "\"", ".html", "/"]) + prose()

    data = [dict(zip(("before", "candidate", "after", "label"), (*(used() if i % 2 else mistaken()), i % 2), strict=True)) for i in range(rows)]
    schema = "array<struct<before:string,candidate:string,after:string,label:int>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(data)), schema)))


def grow(x: np.ndarray, y: np.ndarray, trees: int, depth: int, seed: int) -> list:
    """A random forest: bootstrap rows, a random third of the features at each node, Gini splits.

    A tree is (feature, cut, tree below the cut, tree from the cut on); a leaf is its share of secrets.
    """
    rng = np.random.default_rng(seed)
    width = x.shape[1]

    def node(at: np.ndarray, left: int):
        n, ones = len(at), int(y[at].sum())
        leaf = (ones + 0.5) / (n + 1)
        if not left or ones in (0, n) or n < 6:
            return leaf
        best = None
        for f in rng.choice(width, max(1, width // 3), replace=False).tolist():
            order = at[np.argsort(x[at, f], kind="stable")]
            v, below = x[order, f], np.cumsum(y[order])[:-1]
            k = np.arange(1, n)
            p, q = below / k, (ones - below) / (n - k)
            cost = np.where(v[1:] > v[:-1], k * p * (1 - p) + (n - k) * q * (1 - q), np.inf)
            i = int(cost.argmin())
            if np.isfinite(cost[i]) and (best is None or cost[i] < best[0]):
                best = (cost[i], f, float((v[i] + v[i + 1]) / 2))
        if best is None:
            return leaf
        _, f, cut = best
        low = x[at, f] < cut
        return f, cut, node(at[low], left - 1), node(at[~low], left - 1)

    return [node(rng.integers(0, len(x), len(x)), depth) for _ in range(trees)]


def as_sql(tree, features: str) -> str:
    """The tree over an array of features, as nested conditions."""
    if isinstance(tree, float):
        return f"{tree!r}D"
    f, cut, low, high = tree
    return f"CASE WHEN {features}[{f}] < {cut!r}D THEN {as_sql(low, features)} ELSE {as_sql(high, features)} END"


def forest(findings: DataFrame, trees: int = 24, depth: int = 7, train_rows: int = 3000, seed: int = 5) -> list:
    """Trained from labelled findings, of which train_rows at most, chosen by hash, take part."""
    cols = feature_columns(F.col("before"), F.col("candidate"), F.col("after"))
    known = findings.where("candidate is not null and label is not null").select(F.coalesce("before", F.lit("")).alias("before"), "candidate", F.coalesce("after", F.lit("")).alias("after"), "label")
    picked = known.orderBy(F.xxhash64("before", "candidate", "after"), "before", "candidate", "after", "label").limit(train_rows)
    got = picked.select(F.array(*cols).alias("x"), F.col("label").cast("int").alias("label")).collect()
    if not got:
        return [1.0]
    return grow(np.array([r["x"] for r in got]), np.array([r["label"] for r in got]), trees, depth, seed)


def _judged(rows: DataFrame, trees: list) -> DataFrame:
    """rows, having __text, with __judged: an array of (till, cand, score), an item for each occurrence, and __rest.

    till is the text from the occurrence before up to this one, __rest what follows the last one.

    Everything happens inside the row, so nothing is shuffled; each step is a
    projection of its own, so that none is worked out twice.
    """
    some = F.size("__cands") > 0
    found = rows.withColumn("__cands", F.regexp_extract_all("__text", F.lit(CANDIDATE), F.lit(0)))
    split = found.withColumn("__between", F.when(some, F.split("__text", CANDIDATE, -1)))

    def occurrence(i: Column) -> Column:
        whole, before, after = F.element_at("__cands", i), F.element_at("__between", i), F.element_at("__between", i + 1)
        lead = F.regexp_extract(whole, "^" + LEAD, 0)
        return F.struct(
            F.substring(F.concat(before, lead), -BESIDE, BESIDE).alias("before"),
            whole.substr(F.length(lead) + 1, F.length(whole)).alias("cand"),
            F.substring(after, 1, BESIDE).alias("after"),
            F.concat(before, lead).alias("till"),
        )

    each = split.withColumn("__each", F.when(some, F.transform(F.sequence(F.lit(1), F.size("__cands")), occurrence)))
    weighed = each.withColumn("__x", F.transform("__each", lambda e: F.struct(e["till"].alias("till"), e["cand"].alias("cand"), F.array(*feature_columns(e["before"], e["cand"], e["after"])).alias("x"))))
    total = " + ".join(as_sql(t, "e.x") for t in trees)
    judged = weighed.withColumn("__judged", F.expr(f"transform(__x, e -> named_struct('till', e.till, 'cand', e.cand, 'score', round(({total}) / {len(trees)}, 6)))"))
    rest = F.when(some, F.element_at("__between", -1))
    return judged.withColumn("__rest", rest).drop("__cands", "__between", "__each", "__x")


def _forest(spark: SparkSession, known: DataFrame | None, options: dict) -> list:
    return forest(labelled(spark) if known is None else known, **options)


def findings(docs: DataFrame, known: DataFrame | None = None, least_score: float = 0.5, **options) -> DataFrame:
    """doc_id, nth (from 1), kind, length, digest, score, is_secret of every candidate.

    Of the candidate itself only the SHA-256 is returned.
    """
    rows = project(docs, ["doc_id", "text"]).select("doc_id", F.col("text").alias("__text"))
    at = _judged(rows, _forest(docs.sparkSession, known, options)).select("doc_id", F.posexplode("__judged").alias("nth", "e"))
    cand, score = F.col("e.cand"), F.col("e.score")
    kind = F.coalesce(*[F.when(cand.rlike("^" + p), name) for name, p in FORMATS], F.lit("generic"))
    return at.select("doc_id", (F.col("nth") + 1).alias("nth"), kind.alias("kind"), F.length(cand).alias("length"), F.sha2(cand, 256).alias("digest"), score.alias("score"), (score >= least_score).alias("is_secret"))


def redacted(docs: DataFrame, known: DataFrame | None = None, least_score: float = 0.5, mark: str = "[SECRET]", **options) -> DataFrame:
    """docs, all columns, with mark in place of each occurrence that is judged a secret; the same string elsewhere stands if it is not."""
    names = docs.columns
    inner = [f"__c{i}" for i in range(len(names))]
    text = inner[names.index("text")]
    rows = docs.toDF(*inner).withColumn("__text", F.col(text))
    at = _judged(rows, _forest(docs.sparkSession, known, options))
    parts = F.transform("__judged", lambda e: F.concat(e["till"], F.when(e["score"] >= least_score, F.lit(mark)).otherwise(e["cand"])))
    clean = F.when(F.size("__judged") > 0, F.concat(F.array_join(parts, ""), "__rest")).otherwise(F.col(text))
    return at.select(*[clean.alias(c) if c == text else F.col(c) for c in inner]).toDF(*names)
