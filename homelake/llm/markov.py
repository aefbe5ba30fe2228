"""Secret scan with character Markov models (operator 4), in DataFrame functions only.

Fixed patterns find secrets that are marked as such. For the rest, two first-order character
models are compared: one of random strings, one of ordinary identifiers. A run of token
characters whose log-likelihood ratio is above a threshold is a span of kind ``markov``.

Defined results: null text is empty and has no span; spans are code points of the whole text, end
exclusive; equal spans of different kinds are all kept; repeated rows give repeated results; a
model without samples gives no span of its kind. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import column

# The patterns, and the least length of the last group that counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
# A failing match of these two is a whole run, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Characters that stand for the edge of a run and for the states of the model.
STATES = len(ALPHABET) + 1
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+"
#: Runs below this length are not looked at by the models: they hold too little to decide.
LEAST_RUN = 16
#: Log-likelihood ratio, in nats a character, from which a run is a secret: zero, where both models
#: are as likely.
THRESHOLD = 0.0


def _code(char: Column) -> Column:
    """Place of a character in the alphabet from 1; 0 for the edge of a run."""
    return F.instr(F.lit(ALPHABET), char)


_SPANS = "array<struct<start:int,end:int,found:string>>"
#: Columns that this module adds to a table; none of the table's own may have these names.
_OWN = "__secrets_"


def _with_spans(df: DataFrame, text: str, wanted: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds, for each name, the array of (start, end, found) of a pattern's leftmost matches.

    ``wanted``: name to (pattern, condition under which the text can hold a match). What lies
    between the matches is what a split at the pattern leaves, so places follow from lengths. The
    steps are projections of their own, so that each pattern runs once for each use.
    """
    whole = F.col(text)
    df = df.withColumns(
        {f"{n}_f": F.when(may, F.regexp_extract_all(whole, F.lit(p), F.lit(0))) for n, (p, may) in wanted.items()}
    )
    gaps = {
        f"{n}_g": F.when(F.size(f"{n}_f") > 0, F.transform(F.split(whole, p, -1), F.length)) for n, (p, _) in wanted.items()
    }
    df = df.withColumns(gaps)
    return df.withColumns({n: _places(F.col(f"{n}_g"), F.col(f"{n}_f")) for n in wanted}).drop(
        *[f"{n}{end}" for n in wanted for end in ("_f", "_g")]
    )


def _places(gaps: Column, found: Column) -> Column:
    """Running sums of gaps and lengths, as (start, end, found) of each match."""
    empty = F.array().cast(_SPANS)
    step = F.aggregate(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found")),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, m: F.struct(
            (acc["at"] + m["gap"] + F.length(m["found"])).alias("at"),
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["at"] + m["gap"]).alias("start"),
                        (acc["at"] + m["gap"] + F.length(m["found"])).alias("end"),
                        m["found"].alias("found"),
                    )
                ),
            ).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return F.when(gaps.isNotNull(), step).otherwise(empty)


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["found"].alias("found")),
    )


def _value(span: Column) -> Column:
    return F.regexp_extract(span["found"], ASSIGN, 2)


def with_found(df: DataFrame, text: str, least: int = LEAST_RUN) -> DataFrame:
    """Adds the base spans (start, kind, end, found) and the runs (start, end, found) of a text."""
    low = F.lower(F.col(text))
    # A plain search for the words is cheaper than the pattern, which most texts do not need.
    marked = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        marked = marked | low.contains(word)
    df = _with_spans(
        df,
        text,
        {
            _OWN + "assign": (ASSIGN, marked),
            _OWN + "access": (ACCESS, F.col(text).contains("AKIA")),
            _OWN + "hex": (HEX, F.col(text).rlike("[0-9a-f]{16}")),
            _OWN + "runs": (RUN % least, F.lit(True)),
        },
    )
    assign = F.filter(_OWN + "assign", lambda s: F.length(_value(s)) >= ASSIGN_LEAST)
    base = F.concat(_of_kind(assign, 0), _of_kind(F.col(_OWN + "access"), 1), _of_kind(F.col(_OWN + "hex"), 2))
    return df.withColumn(_OWN + "base", base).drop(*[_OWN + n for n in ("assign", "access", "hex")])


def train(samples: DataFrame) -> DataFrame:
    """Transition weights (from, to, weight) from labelled samples (run, is_secret).

    The weight is the difference of the two models' log probabilities, with one added to each
    count. At most STATES squared rows, whatever the number of samples.
    """
    coded = samples.select("is_secret", F.explode(_transitions(F.col("run"))).alias("t"))
    counts = coded.groupBy(F.col("t.from").alias("from"), F.col("t.to").alias("to")).agg(
        F.count_if("is_secret").alias("secret"), F.count_if(~F.col("is_secret")).alias("plain")
    )
    grid = samples.sparkSession.range(STATES * STATES).select(
        F.floor(F.col("id") / STATES).cast("int").alias("from"), (F.col("id") % STATES).cast("int").alias("to")
    )
    full = grid.join(counts, ["from", "to"], "left").na.fill(0, ["secret", "plain"])
    sums = full.groupBy("from").agg(F.sum("secret").alias("all_secret"), F.sum("plain").alias("all_plain"))
    p = lambda n, total: (F.col(n) + 1.0) / (F.col(total) + float(STATES))
    return full.join(sums, "from").select(
        "from", "to", F.round(F.log(p("secret", "all_secret")) - F.log(p("plain", "all_plain")), 9).alias("weight")
    )


def _transitions(run: Column) -> Column:
    """(from, to) of each two neighbouring characters, the edge of the run before the first."""
    chars = F.split(run, "")
    return F.transform(
        chars,
        lambda c, i: F.struct(
            F.when(i == 0, 0).otherwise(_code(F.element_at(chars, F.greatest(i, F.lit(1))))).alias("from"), _code(c).alias("to")
        ),
    )


def ratio(run: Column, weights: Column) -> Column:
    """Log-likelihood ratio of a run in nats a character. ``weights``: by from * STATES + to."""
    total = F.aggregate(
        F.split(run, ""),
        F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(
            _code(c).alias("before"), (acc["sum"] + F.get(weights, acc["before"] * STATES + _code(c))).alias("sum")
        ),
        lambda acc: acc["sum"],
    )
    return total / F.length(run)


def weights_of(model: DataFrame) -> Column:
    """The model as one array literal; its size is fixed by the alphabet."""
    rows = model.orderBy("from", "to").collect()
    return F.split(F.lit(",".join(repr(r["weight"]) for r in rows)), ",").cast("array<double>")


def labelled_runs(docs: DataFrame, text: str = "text", least: int = LEAST_RUN) -> DataFrame:
    """Samples (run, is_secret) from all texts: those in what a fixed pattern marks, and all others.

    Marked are the values of assignments, access keys and hexadecimal runs. Runs without a letter
    are numbers and no sample of either.
    """
    rows = with_found(docs.select(column(text).alias("text")).where("text is not null"), "text", least)
    marked = F.transform(_OWN + "base", lambda s: F.when(s["kind"] == 0, _value(s)).otherwise(s["found"]))
    each = rows.select(F.explode(F.col(_OWN + "runs")["found"]).alias("run"), marked.alias("marked"))
    secret = F.exists("marked", lambda m: m.contains(F.col("run")))
    return each.where(F.col("run").rlike("[A-Za-z]")).select("run", secret.alias("is_secret"))


def with_secrets(
    df: DataFrame, text: str, weights: Column, threshold: float = THRESHOLD, least: int = LEAST_RUN
) -> DataFrame:
    """Adds ``__secrets_base`` and ``__secrets_all``: arrays of (start, kind, end, found) in order
    of start and kind. ``text`` must not be null."""
    df = with_found(df, text, least)
    secret = F.filter(_OWN + "runs", lambda s: s["found"].rlike("[A-Za-z]") & (ratio(s["found"], weights) >= threshold))
    df = df.withColumn(_OWN + "more", _of_kind(secret, 3)).drop(_OWN + "runs")
    return df.withColumns(
        {_OWN + "base": F.array_sort(_OWN + "base"), _OWN + "all": F.array_sort(F.concat(_OWN + "base", _OWN + "more"))}
    ).drop(_OWN + "more")


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text, base, spans) for every row, with models learned from all rows."""
    weights = weights_of(train(labelled_runs(docs, text)))
    rows = docs.select(column(doc_id).alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))
    return with_secrets(rows, "text", weights, threshold).select(
        "doc_id", "text", F.col(_OWN + "base").alias("base"), F.col(_OWN + "all").alias("spans")
    )


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span, or chain of overlapping spans, replaced by ``mask``."""
    out = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, out).otherwise(text)


def mask_secrets(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with secrets in the text masked; null texts stay null.

    Where the table has the length column, it is set anew for texts that changed.
    """
    weights = weights_of(train(labelled_runs(docs, text)))
    own = _OWN + "text"
    rows = with_secrets(docs.withColumn(own, F.coalesce(column(text), F.lit(""))), own, weights)
    some = F.size(_OWN + "all") > 0
    rows = rows.withColumn(text, F.when(some, masked(F.col(own), F.col(_OWN + "all"))).otherwise(column(text)))
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        rows = rows.withColumn(n_chars, F.when(some, F.length(column(text)).cast(kind)).otherwise(column(n_chars)))
    return rows.select(*[column(c) for c in docs.columns])
