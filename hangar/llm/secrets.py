"""Secret scans (operator 6), native.

Method: incremental blob ledger.  Every version of a text is content-addressed
(SHA-256); the ledger lists, per blob, the rule versions it was scanned with
and the findings.  A run scans only unseen (blob, rule version) pairs, each
blob once however many paths hold it, and joins the findings back to all
paths.  The ledger counts the rows that hold a blob; one that many hold is joined
back in parts, so that no task meets all its rows.  Everything is DataFrame functions:
match positions follow from the lengths of the matches and of the gaps between them.

Nulls count as the empty text; an empty text has no findings; repeated rows
and copies share a blob and each get its findings; an empty table gives an
empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangar.llm.common import staged, table


class Rule(NamedTuple):
    """``pattern`` is matched leftmost and without overlap; a match counts if
    ``group`` has at least ``least`` characters.  ``gate``: a literal that every
    match holds, looked for first."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    gate: str | None = None
    version: int = 1


#: A blob that more than one row in so many holds is joined back in parts.
SHARE = 1_024

#: The base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: A private key, from its BEGIN to the matching END; without one, to the end of the
#: headers and base64 lines that follow (line breaks may be written as backslash n).
_LINE = r"[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+"
_STOP = r"(?=[\x20\t]*+(?:[\r\n]|\\[rn]|\z))"
PEM = (r"-----BEGIN ((?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?)-----"
       r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END \1-----"
       rf"|(?:{_LINE}[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+)*+(?:{_LINE}(?=\r?\n|\\))?+"
       rf"(?:{_LINE}[A-Za-z0-9+/=]{{16,}}+{_STOP})++(?:{_LINE}=?[A-Za-z0-9+/]{{1,15}}+={{0,2}}{_STOP}){{0,2}}+)?")
#: Further kinds of credentials, each with a fixed marker.
MORE = (
    Rule("private_key", PEM, gate="PRIVATE KEY", version=2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", gate=".eyJ"),
    Rule("vcs_token", r"gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{60,}", gate="gh"),
    Rule("ci_token", r"glpat-[A-Za-z0-9_-]{20,}", gate="glpat-"),
    Rule("chat_token", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", gate="xox"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}", gate="AIza"),
    Rule("pay_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}", gate="k_"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s/:@]*+:[^\s/@]++@[A-Za-z0-9.-]+", gate="://", version=2),
    Rule("bearer", r"(?i)\bbearer\x20+[A-Za-z0-9._~+/-]{20,}=*", gate="earer"),
)
RULES = BASE + MORE

SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _key(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Sorted spans of a rule in a text: code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.transform(found, F.length)
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)),
                       F.length) if rule.group else sizes
    # The state runs over the matches: where the last one ended, and the spans.
    start = lambda s, m: s["at"] + m["gap"]
    out = F.aggregate(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"),
                     sizes.alias("size"), kept.alias("kept")),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")),
        lambda s, m: F.struct(
            (start(s, m) + m["size"]).alias("at"),
            F.when(m["kept"] >= rule.least, F.concat(s["spans"], F.array(F.struct(
                start(s, m).alias("start"), F.lit(rank).alias("rank"),
                F.lit(rule.kind).alias("kind"), (start(s, m) + m["size"]).alias("end")))))
            .otherwise(s["spans"]).alias("spans")),
        lambda s: s["spans"])
    hit = F.regexp_like(text, pattern)
    if rule.gate:
        hit = F.contains(text, F.lit(rule.gate)) & hit
    return F.when(hit, out).otherwise(F.array().cast(SPAN))


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(versions: DataFrame, rules: tuple[Rule, ...] = RULES,
         ledger: DataFrame | None = None) -> DataFrame:
    """Ledger entries of the blobs of ``versions`` (column text).

    Returns blob, copies (rows of ``versions`` that hold it), rules (array of
    kind@version scanned by now) and findings (array of spans); to be written before
    it is joined back.  ``ledger`` is an earlier result; pairs that it lists are not
    scanned again, and findings of superseded rule versions go.
    """
    blobs = versions.select(address(F.col("text")).alias("blob"),
                            F.coalesce("text", F.lit("")).alias("text")).groupBy("blob").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    keys = F.array(*[F.lit(_key(r)) for r in rules])
    if ledger is None:
        scanned = blobs.select("blob", "copies", F.concat(
            *[spans(F.col("text"), r, i) for i, r in enumerate(rules)]).alias("new"))
        return scanned.select("blob", "copies", keys.alias("rules"),
                              F.array_sort("new").alias("findings"))
    old = ledger.select("blob", F.col("rules").alias("_seen"), F.col("findings").alias("_old"))
    known = blobs.join(old, "blob", "left")
    unseen = lambda r: ~F.coalesce(F.array_contains("_seen", _key(r)), F.lit(False))
    new = F.concat(*[F.when(unseen(r), spans(F.col("text"), r, i)).otherwise(
        F.array().cast(SPAN)) for i, r in enumerate(rules)])
    live = F.array(*[F.when(~unseen(r), F.lit(r.kind)) for r in rules])
    kept = F.filter(F.coalesce("_old", F.array().cast(SPAN)),
                    lambda f: F.coalesce(F.array_contains(live, f["kind"]), F.lit(False)))
    return known.select("blob", "copies", keys.alias("rules"),
                        F.array_sort(F.concat(new, kept)).alias("findings"))


def dealt(rows: DataFrame, found: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` and ``found`` (both with _blob) with a column _part to join on as well.

    Blobs that more than one row in ``SHARE`` holds, at most ``SHARE`` of them, are dealt to
    parts below that share; their entries of ``found`` are there once per part.
    """
    total = ledger.agg(F.sum("copies")).first()[0] or 1
    often = F.col("copies") * SHARE / F.lit(total)
    hot = F.broadcast(ledger.where((often > 1) & (F.col("copies") > 1)).select(
        F.col("blob").alias("_blob"), F.least(F.ceil(often), "copies").cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    return (rows.withColumn("_part", F.xxhash64(F.monotonically_increasing_id()))
            .join(hot, "_blob", "left")
            .withColumn("_part", F.pmod("_part", parts).cast("int")).drop("_parts"),
            found.join(hot, "_blob", "left")
            .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))


def findings(paths: DataFrame, ledger: DataFrame, path: str = "doc_id") -> DataFrame:
    """The findings of the blob that each path holds; ``ledger`` covers all paths."""
    rows, found = dealt(paths.select(F.col(path), address(F.col("text")).alias("_blob")),
                        ledger.select(F.col("blob").alias("_blob"), "findings"), ledger)
    return rows.join(found, ["_blob", "_part"]).select(path, "findings")


def _text(spans_: Column) -> Column:
    return F.concat_ws(",", F.transform(spans_, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def op6_secret_scan(spark, sf_dir):
    """Base counts, hash of the base spans, and all spans of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = findings(docs, staged(scan(docs), "secret_ledger"))
    base = F.filter("findings", lambda f: f["rank"] < len(BASE))
    count = lambda k: F.size(F.filter("findings", lambda f: f["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("findings")).alias("spans"))


def redact(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by [kind]; n_chars follows,
    other columns stay.

    Overlapping spans are replaced as one, under the first one's name.
    """
    def step(s, f):
        return F.when(f["start"] < s["at"], F.struct(
            s["out"].alias("out"), F.greatest(s["at"], f["end"]).alias("at"))).otherwise(F.struct(
                F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, f["start"] - s["at"]),
                         F.lit("["), f["kind"], F.lit("]")).alias("out"), f["end"].alias("at")))

    found = ledger.where(F.size("findings") > 0).select(
        F.col("blob").alias("_blob"), F.col("findings").alias("_found"))
    rows, found = dealt(docs.withColumn("_blob", address(F.col("text"))), found, ledger)
    marked = rows.join(found, ["_blob", "_part"], "left")
    clean = F.aggregate("_found", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                        lambda s: F.concat(s["out"], F.substring(
                            F.col("text"), s["at"] + 1, F.length("text"))))
    hit = F.col("_found").isNotNull()
    out = marked.withColumn("text", F.when(hit, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
