"""Secret scans over a blob ledger.

Every version of a text is addressed by its SHA-256. The ledger has a row per blob: which rule versions have
scanned it, and the spans they found; ``Ledger`` keeps it at a path from run to run. A scan takes the texts of its paths, keeps one per blob, and runs only the
rule versions that the ledger lacks for it; findings are then joined back to every path that holds the blob. Raising a
rule's version, or adding a rule, rescans with that rule alone.

Only SQL functions run on the data. Matches come from one regular expression per rule, leftmost and not
overlapping; their places follow from the gaps between them (``split`` on the same expression), in code points,
end exclusive; sums over the gaps go by blocks, so that a text of a hundred thousand matches takes seconds. Rules: ``assign`` (a value of 8 characters or more after password, token ...), ``access`` (AKIA keys of 16 or
more), ``hex`` (32 or more); and, beyond the base, ``pem``, ``github``, ``slack`` and ``jwt``.

Nulls and edges: a null text is the empty blob, with no findings. Rows are returned one for one, repeated rows
and null ids too; other columns are ignored. Equal blobs are scanned once, however many paths hold them (a hot blob is one row
after map-side combination, and a skewed join that AQE splits on the way back). An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgecast.llm.store import materialize


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Cheap test that any text with a match passes.
    gate: str
    #: Of each match: the capture group whose length is tested, and the least length.
    group: int = 0
    least: int = 1
    version: int = 1
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The rules, in the order in which kinds are listed.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"(?i)(?:passw|secret|token|api_?key)", 2, 8, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", "AKIA", 0, 16, base=True),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{32}", 0, 32, base=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", r"gh[pousr]_", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", "xox", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "eyJ"),
)
SPANS = "array<struct<s:int,o:int,e:int,kind:string>>"
LEDGER = f"blob string, scanned array<string>, spans {SPANS}"


def _literal(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with a lambda variable for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _spans(rule: Rule, order: int) -> Column:
    """Spans of one rule in column ``text``: the matches' lengths and the gaps between them give the places."""
    # Hexadecimal runs shorter than the least length are everywhere; matching them whole or not at all is the same.
    pattern = r"(?<![0-9a-f])[0-9a-f]{32,}" if rule.kind == "hex" else rule.pattern
    p = _literal(pattern)
    gate = f"text rlike {_literal(rule.gate)}" if any(x in rule.gate for x in "([{") else f"contains(text, {_literal(rule.gate)})"
    # Lengths before a match: whole blocks of about the square root of all matches, then the matches of its own block.
    total = lambda what, first, n: f"aggregate(slice({what}, cast({first} as int), cast({n} as int)), 0, (a, x) -> a + x)"
    step = "cast(ceil(sqrt(size(found))) as int)"
    before = f"{total('blocks', '1', '(i - 1) div w')} + {total('lengths', '((i - 1) div w) * w + 1', '(i - 1) % w')} + length(element_at(gaps, i))"
    made = f"""transform(
        filter(sequence(1, size(found)), i -> length(element_at(tested, i)) >= {rule.least}),
        i -> {_let("s", before, f"named_struct('s', s, 'o', {order}, 'e', s + length(element_at(found, i)), 'kind', '{rule.kind}')")})"""
    made = _let("blocks", f"transform(sequence(0, (size(found) - 1) div w), j -> {total('lengths', 'cast(j * w + 1 as int)', 'w')})", made)
    made = _let("lengths", "zip_with(gaps, found, (x, y) -> length(x) + coalesce(length(y), 0))", _let("w", step, made))
    for name, value in (("gaps", f"split(text, {p}, -1)"), ("tested", f"regexp_extract_all(text, {p}, {rule.group})"), ("found", f"regexp_extract_all(text, {p}, 0)")):
        made = _let(name, value, made)
    return F.expr(f"case when {gate} then case when text rlike {p} then cast({made} as {SPANS}) else cast(array() as {SPANS}) end else cast(array() as {SPANS}) end")


def with_blob(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("text", text).withColumn("blob", F.sha2(text, 256))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The new ledger: the old one's rows, and for every blob in ``docs`` (text) the spans of all ``rules``.

    Only (blob, rule version) pairs that ``ledger`` lacks are scanned. Spans of other versions of a rule are dropped.
    """
    keys = F.array(*[F.lit(r.key) for r in rules])
    texts = with_blob(docs.select("text")).select("blob", "text").groupBy("blob").agg(F.first("text").alias("text"))
    first = ledger is None
    ledger = docs.sparkSession.createDataFrame([], LEDGER) if first else ledger
    had = ledger.select("blob", F.col("scanned").alias("had"), F.col("spans").alias("old"))
    at = texts.join(had, "blob", "left").withColumn("had", F.coalesce("had", F.array().cast("array<string>"))).withColumn("old", F.coalesce("old", F.array().cast(SPANS)))
    fresh = [F.when(~F.array_contains("had", r.key), _spans(r, i)).otherwise(F.array().cast(SPANS)) for i, r in enumerate(rules)]
    current = F.transform(F.array_intersect("had", keys), lambda x: F.split_part(x, F.lit("@"), F.lit(1)))
    kept = F.filter("old", lambda x: F.array_contains(current, x["kind"]))
    new = at.select("blob", keys.alias("scanned"), F.array_sort(F.concat(kept, *fresh)).alias("spans"))
    if first:
        return new
    return ledger.join(texts.select("blob"), "blob", "left_anti").select("blob", "scanned", "spans").unionByName(new)


class Ledger:
    """A ledger kept at ``path``, a folder that the cluster shares: each update writes a new version whole and the last complete one counts.

    A run that fails leaves the last version as it was. Versions before the last two are removed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        if not self._fs.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._folder)]
        done = lambda n: self._fs.exists(self._folder.suffix(f"/{n}/_SUCCESS"))
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and done(n))

    def read(self) -> DataFrame | None:
        """The last version; None before the first update."""
        have = self.versions()
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/v{have[-1]}") if have else None

    def update(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scans what is new in ``docs`` (text) and returns the new version."""
        have = self.versions()
        scan(docs, self.read(), rules).write.mode("overwrite").parquet(f"{self.path}/v{have[-1] + 1 if have else 0}")
        for n in have[:-1]:
            self._fs.delete(self._folder.suffix(f"/v{n}"), True)
        return self.read()


def unseen(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``docs`` with the number of rules that have not seen its blob: doc_id, n_unseen."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    seen = ledger.select("blob", F.size(F.array_intersect("scanned", keys)).alias("n"))
    return with_blob(docs.select("doc_id", "text")).select("doc_id", "blob").join(seen, "blob", "left").select("doc_id", (F.lit(len(rules)) - F.coalesce("n", F.lit(0))).cast("long").alias("n_unseen"))


def findings(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its blob's spans: doc_id, spans (by start, then kind as listed)."""
    paths = with_blob(docs.select("doc_id", "text")).select("doc_id", "blob")
    return paths.join(ledger.select("blob", "spans"), "blob", "left").select("doc_id", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, a count per base kind, base_sha256 and spans, as text."""
    named = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")
    base = [r.kind for r in rules if r.base]
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(kind) for kind in base]
    only = F.filter("spans", lambda x: x["kind"].isin(base))
    return found.select("doc_id", *counts, F.sha2(named(only), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, ledger: DataFrame | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` and n_chars, if there, counted anew.

    ``ledger`` is one that has all blobs of ``docs``, as ``Ledger.update`` returns it; without it they are scanned.
    """
    book = (materialize(scan(docs), "ledger") if ledger is None else ledger).where(F.size("spans") > 0).select("blob", F.col("spans").alias("__spans"))
    cut = F.expr(
        f"""aggregate(__spans, named_struct('at', 0, 'out', ''),
            (a, x) -> named_struct('at', greatest(a.at, x.e), 'out',
                case when x.s >= a.at then concat(a.out, substring(text, a.at + 1, x.s - a.at), {_literal(mark)}) else a.out end),
            a -> concat(a.out, substring(text, a.at + 1)))"""
    )
    marked = docs.withColumn("__blob", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).join(book.withColumnRenamed("blob", "__blob"), "__blob", "left")
    out = marked.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(docs.columns)
