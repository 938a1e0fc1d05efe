"""Secret scans over every historical version, by an incremental ledger of blobs.

A blob is a text, addressed by its SHA-256. The ledger, a Parquet table in a shared folder,
says which (blob, rule version) pairs have been scanned and what was found, also if that was
nothing. A scan computes the addresses of all versions given, scans only the pairs that the
ledger lacks, each blob once however many paths and versions hold it, and joins the findings
back to all of them. A rule is scanned anew once its version changes.

Everything is built-in functions: a text is split at a rule's matches, and the lengths of the
pieces and the matches give the positions, in code points.

Defined results: a NULL text is an empty one. Repeated rows each get the findings. Other
columns of the versions are carried along, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talmir.llm.common import stored

LEDGER_SCHEMA = (
    "blob string, scanned array<string>, "
    "spans array<struct<start: bigint, place: int, kind: string, end: bigint, rule: string>>"
)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed patterns of the three base kinds, then those that this library adds. The lengths of
# access and hex are in their patterns: such a match is a whole run of its characters, so no
# run that is too short holds a match that is not.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# A private key runs from its BEGIN line through the END line, unless another BEGIN or END comes
# first. Where END is missing, it runs to the last line of base64, which headers may stand before.
# Line ends may be written as \\n, as in JSON. Repetitions are possessive or of one character, as
# others take stack for each round.
_LINE_END = r"(?:[\x20\t>]*+(?:\r?\n|\\r|\\n))"
_BASE64 = r"[\x20\t>]*+[A-Za-z0-9+/=]++(?![\x20\t]*+[^\x20\t\r\n\\\"'<])"
_HEADER = r"[\x20\t>]*+[A-Z][A-Za-z]*+-[A-Za-z-]++:[^\r\n\\]*+"
_PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:(?>[\s\S]*?(?=-----(?:BEGIN|END) ))-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_LINE_END}{_HEADER})*+{_LINE_END}++{_BASE64}(?:{_LINE_END}{_BASE64})*+)?"
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("private_key", _PRIVATE_KEY, version=2),
)
RULES = BASE_RULES + MORE_RULES


# Elements that a running fold copies at a time.
RUN = 128
# Code points of the parts that a text is cut into before it is masked.
PART = 4096


def _let(value: Column, use) -> Column:
    """use(value), the value computed once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, op, start: int) -> Column:
    """Array of the folds of all elements before each one, for an associative ``op`` on bigints.

    One fold that grows its array would copy it for each element. So runs of RUN elements are
    folded on their own, from where the runs before them end.
    """
    first = F.lit(start).cast("bigint")

    def grow(array: Column, begin: Column) -> Column:
        state = F.struct(begin.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            array,
            state,
            lambda s, x: F.struct(
                op(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")
            ),
            lambda s: s["out"],
        )

    def of(v: Column) -> Column:
        count = F.ceil(F.size(v) / RUN).cast("int")
        places = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: i * RUN + 1)
        runs = F.transform(places, lambda i: F.slice(v, i, F.lit(RUN)))
        return _let(runs, lambda r: _let(
            grow(F.transform(r, lambda x: F.aggregate(x, first, op)), first),
            lambda begins: F.flatten(F.zip_with(r, begins, grow)),
        ))

    return _let(values, of)


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Array of the rule's spans in the text, in order.

    The lengths of gaps and matches before a match add up to where it starts; a match that fails
    counts for the places of later ones, and is left out.
    """
    regex = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    tested = whole if rule.group == 0 else F.regexp_extract_all(text, regex, F.lit(rule.group))
    pieces = F.split(text, rule.pattern, -1)
    kind = "array<struct<start: bigint, place: int, kind: string, end: bigint, rule: string>>"

    def of(x: Column) -> Column:
        sizes = F.transform(x["whole"], F.length)
        lengths = F.arrays_zip(
            F.transform(x["pieces"], F.length).alias("gap"),
            sizes.alias("size"),
            F.transform(x["tested"], F.length).alias("tested"),
        )

        def placed(found: Column) -> Column:
            moved = F.transform(found, lambda y: (y["gap"] + F.coalesce(y["size"], F.lit(0))).cast("bigint"))
            both = F.zip_with(
                found,
                _running(moved, lambda s, y: s + y, 0),
                lambda y, before: F.struct((before + y["gap"]).alias("begin"), y["size"], y["tested"]),
            )
            good = F.filter(both, lambda y: F.coalesce(y["tested"] >= rule.least, F.lit(False)))
            return F.transform(
                good,
                lambda y: F.struct(
                    y["begin"].alias("start"),
                    F.lit(place).alias("place"),
                    F.lit(rule.kind).alias("kind"),
                    (y["begin"] + y["size"]).alias("end"),
                    F.lit(rule.name).alias("rule"),
                ),
            )

        return _let(lengths, placed).cast(kind)

    # Most texts have no match, and are not cut.
    return _let(whole, lambda w: F.when(F.size(w) == 0, F.array().cast(kind)).otherwise(
        _let(F.struct(pieces.alias("pieces"), w.alias("whole"), (w if rule.group == 0 else tested).alias("tested")), of)
    ))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _exists(spark, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger, or an empty one where nothing has been written yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def update_ledger(
    versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Scan what the ledger lacks, append it, and return the rows appended.

    One text per blob is taken on the map side already, so copies are not shuffled. Of texts that
    the ledger knows, only the addresses are.
    """
    spark = versions.sparkSession
    wanted = [rule.name for rule in rules]
    names = F.array(*[F.lit(name) for name in wanted])
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    blobs = versions.select(blob_of(F.col(text)).alias("blob"), content.alias("content"))
    if _exists(spark, ledger):
        # Addresses first: only texts that lack a rule are fetched.
        scanned = read_ledger(spark, ledger).select("blob", F.explode("scanned").alias("rule"))
        seen = scanned.filter(F.col("rule").isin(wanted)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        lacking = blobs.select("blob").distinct().join(seen, "blob", "left").select(
            F.col("blob").alias("lacking"), F.array_except(names, F.coalesce("seen", F.array())).alias("scanned")
        )
        lacking = stored(lacking.filter(F.size("scanned") > 0), "unseen")
        pending = blobs.join(lacking, F.col("blob") == F.col("lacking"))
    else:
        pending = blobs.withColumn("scanned", names)
    # Copies are combined in the tasks that read them, so a very frequent text is not shuffled.
    pending = pending.groupBy("blob").agg(F.first("content").alias("content"), F.first("scanned").alias("scanned"))
    nothing = F.array()
    found = [
        F.when(F.array_contains("scanned", rule.name), _spans(F.col("content"), rule, i)).otherwise(
            nothing
        )
        for i, rule in enumerate(rules)
    ]
    rows = pending.select("blob", "scanned", F.concat(*found).alias("spans"))
    rows = rows.select(*[F.col(f.name) for f in rows.schema.fields])
    new = stored(rows, "secret-scan")
    new.write.mode("append").parquet(ledger)
    return new


def findings(
    versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Every version with ``blob`` and ``spans``, joined from the ledger; columns of these names,
    in any case, are replaced.

    Only blobs with findings are joined, by shuffle, as their number grows with the versions and
    spans take far less in files than as rows. Spark splits the join at a very frequent blob.
    """
    wanted = [rule.name for rule in rules]
    kept = F.filter("spans", lambda s: s["rule"].isin(wanted))
    found = read_ledger(versions.sparkSession, ledger).select(F.col("blob").alias("of"), kept.alias("spans"))
    found = found.filter(F.size("spans") > 0)
    # A blob has several rows if rules were added later; a pair scanned twice counts once.
    # Sorted, equal spans are neighbours; array_distinct compares all pairs of structs.
    once = lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1)))
    found = found.groupBy("of").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    found = found.select("of", _let(F.col("spans"), once).alias("spans"))
    # The versions' own columns are packed, so that their names meet no others.
    packed = versions.select(F.struct("*").alias("row"), blob_of(F.col(text)).alias("blob"))
    joined = packed.join(found.hint("merge"), F.col("blob") == F.col("of"), "left")
    names = [c for c in versions.columns if c.lower() not in ("blob", "spans")]
    return joined.select(
        *[F.col("row")[c].alias(c) for c in names], "blob", F.coalesce("spans", F.array()).alias("spans")
    )


def scan(
    versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Bring the ledger up to date with the versions, and return their findings."""
    update_ledger(versions, ledger, text, rules)
    return findings(versions, ledger, text, rules)


def mask(text: Column, spans: Column, by: str = "*") -> Column:
    """The text with every span's characters replaced. Overlapping spans are masked once.

    spans are in the order of their starts. The text is cut into parts once, as finding a place
    in a string takes time in proportion to the place.
    """

    def between(parts: Column, begin: Column, end: Column) -> Column:
        """The text from begin to end, from the parts that these lie in and all parts between."""
        first, last = F.floor(begin / PART).cast("int"), F.floor(end / PART).cast("int")
        at = (begin - first * PART).cast("int")
        until = (end - last * PART).cast("int")
        # The last place of a text may lie just after its last part.
        part = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
        inside = F.substr(part(first), at + 1, F.greatest(until - at, F.lit(0)))
        middle = F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        across = F.concat(
            F.substr(part(first), at + 1, F.lit(PART)), middle, F.substr(part(last), F.lit(1), until)
        )
        return F.when(end <= begin, F.lit("")).when(first == last, inside).otherwise(across)

    def masked(x: Column) -> Column:
        ends = F.transform(x["spans"], lambda s: s["end"])
        reach = _running(ends, lambda a, b: F.greatest(a, b), 0)
        pieces = F.zip_with(
            x["spans"],
            reach,
            lambda s, before: F.concat(
                between(x["parts"], before, s["start"]),
                F.repeat(F.lit(by), F.greatest(s["end"] - F.greatest(before, s["start"]), F.lit(0)).cast("int")),
            ),
        )
        tail = between(x["parts"], F.array_max(ends), F.char_length(text).cast("bigint"))
        return F.concat(F.array_join(pieces, ""), tail)

    cut = F.struct(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)).alias("parts"), spans.alias("spans")
    )
    return F.when(F.size(spans) == 0, text).otherwise(_let(cut, masked))


def mask_secrets(
    docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The documents, with their own columns, every secret in their text replaced by asterisks."""
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text"))
    found = scan(packed, ledger, "_text", rules)
    masked = mask(F.col("_text"), F.col("spans")).alias(text)
    return found.select(*[masked if c == text else F.col("_doc")[c].alias(c) for c in docs.columns])
