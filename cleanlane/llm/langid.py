"""Language identification by Bayesian fusion of evidence.

For every document four kinds of evidence are combined as log probabilities:

- the text: a naive Bayes model over hashed byte trigrams, fitted on a sample
  of labelled rows of at most ``TRAIN_ROWS`` rows (on average; chosen by a
  hash of the text and its row, equal parts of all labels), tempered because neighbouring
  trigrams are not independent;
- the declared markup language and the address suffix: P(value | language),
  smoothed, from grouped sums of the text's probabilities over all rows;
- the host: P(language | host), smoothed towards its domain, that towards the
  whole corpus, without the row's own share.

The sums are grouped aggregations that combine before they shuffle, so a hot
host is one row per task.  Hosts' priors are joined back to rows that carry a
few numbers and no text.

A document is rejected (language 'und') if it has no letters, if its best
language has less than ``confidence``, or if its text is far less likely, for
each trigram, than any training text of the best language (an unknown
language or no language at all).

Defined results.  A null or empty text has no text evidence and is 'und'
whatever is declared.  Null declared values, suffixes and hosts are values of
their own.  Labels outside of ``languages`` are not trained on.  Repeated rows
are judged each.  Empty tables give no rows; with no labelled row every
document is 'und'.  Other columns stay, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, lower_ascii, ship, small_batches, text_slices, trim
from .urlfilter import host_of

ship(__name__)

LANGUAGES = ("de", "en", "es", "fr")
#: Bound of the labelled sample; buckets of the hashed trigrams.
TRAIN_ROWS, BUCKETS = 40_000, 1 << 16
#: Weight of the text's log likelihood; pseudo-counts of a host's and of a domain's prior, and of declared values.
TEMPER, PRIOR, VALUE = 0.2, 10.0, 0.5
#: How far below the training texts' mean (nats a trigram) a text is still of a known language; shorter texts aren't judged so.
FAR, LEAST = 4.0, 40


def _fold() -> np.ndarray:
    out = np.full(256, 32, np.uint32)
    out[97:123] = np.arange(97, 123)
    out[65:91] = np.arange(97, 123)
    out[128:] = np.arange(128, 256)
    return out


FOLD = _fold()


def codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that begins at each byte; none at a text's last two."""
    f = np.concatenate([FOLD[data], np.full(2, 32, np.uint32)])
    g = (f[:-2] << np.uint32(16)) | (f[1:-1] << np.uint32(8)) | f[2:]
    blank = g == 0x202020
    out = ((g * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
    out[blank] = BUCKETS  # trigrams without a letter say nothing
    for back in (1, 2):
        last = offsets[1:] - back
        out[last[last >= offsets[:-1]]] = BUCKETS
    return out


def _trainer(languages: tuple[str, ...]):
    """Rows (lang, bucket, n): trigram counts of a task's texts."""

    def run(batches):
        import pyarrow as pa

        totals = np.zeros((len(languages), BUCKETS + 1), np.int64)
        for batch in batches:
            lang = np.array([languages.index(x) for x in batch.column(0).to_pylist()], np.int64)
            for at, data, offsets in text_slices(batch.column(1)):
                owner = np.repeat(lang[at : at + len(offsets) - 1], np.diff(offsets))
                totals += np.bincount(owner * (BUCKETS + 1) + codes(data, offsets), minlength=totals.size).reshape(totals.shape)
        lang, bucket = np.nonzero(totals[:, :BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int64)), pa.array(totals[lang, bucket])], names=["lang", "bucket", "n"])

    return run


class Model:
    """Log probabilities of the buckets for each language, and each language's mean over its own trigrams."""

    def __init__(self, counts: np.ndarray, languages: tuple[str, ...]):
        self.languages = languages
        smooth = counts + 0.5
        share = smooth / smooth.sum(1, keepdims=True)
        self.weights = np.zeros((len(languages), BUCKETS + 1), np.float32)
        self.weights[:, :BUCKETS] = np.log(share)
        self.mean = (counts * np.log(share)).sum(1) / np.maximum(counts.sum(1), 1)


def score(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihood in each language, number of trigrams) of each text."""
    own = codes(data, offsets)
    ends = np.concatenate([np.zeros(1), np.cumsum(own < BUCKETS)])
    out = np.empty((len(offsets) - 1, len(weights)))
    for j, each in enumerate(weights):
        sums = np.concatenate([np.zeros(1), np.cumsum(each[own], dtype=np.float64)])
        out[:, j] = sums[offsets[1:]] - sums[offsets[:-1]]
    return out, ends[offsets[1:]] - ends[offsets[:-1]]


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", languages: tuple[str, ...] = LANGUAGES, rows: int = TRAIN_ROWS) -> Model:
    """Fit the text model on at most about ``rows`` labelled rows."""
    labelled = docs.filter(F.col(lang).isin(*languages)).select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("text is not null")
    sizes = dict(docs.filter(F.col(lang).isin(*languages)).groupBy(lang).count().collect())
    each = max(1, rows // len(languages))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, each / n))).otherwise(share)
    # by text and row, so that a text that very many rows have enters with its share of them only
    row = F.xxhash64("text", F.monotonically_increasing_id())
    sample = labelled.filter(F.pmod(row, F.lit(1 << 20)) < share * (1 << 20))
    with small_batches(docs.sparkSession):
        got = sample.mapInArrow(_trainer(languages), "lang int, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), BUCKETS))
    counts[got["lang"], got["bucket"]] = got["n"]
    return Model(counts, languages)


def _scorer(shared, text_at: int, kept: int):
    """The rows' kept columns with their scores; ``text_at`` is the text's column, and is not kept."""

    def run(batches):
        import pyarrow as pa

        trim()
        weights = shared.value
        for batch in batches:
            scores, sizes = [], []
            for _, data, offsets in text_slices(batch.column(text_at)):
                s, n = score(weights, data, offsets)
                scores.append(s)
                sizes.append(n)
            s = np.concatenate([*scores, np.zeros((0, len(weights)))])
            n = np.concatenate([*sizes, np.zeros(0)]).astype(np.int64)
            columns = [batch.column(i) for i in range(kept)]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * s.shape[1], pa.int32()), pa.array(s.ravel())), pa.array(n)], names=[*[f"c{i}" for i in range(kept)], "scores", "trigrams"])

    return run


def with_scores(docs: DataFrame, model: Model, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` as c0, c1, ... with scores (log likelihoods) and trigrams (their number)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    rows = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(keep)], text.alias("text"))
    types = ", ".join(f"c{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    return rows.mapInArrow(_scorer(shared, len(keep), len(keep)), f"{types}, scores array<double>, trigrams long")


def _total(c) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def with_softmax(rows: DataFrame, logs: Column, name: str) -> DataFrame:
    """``rows`` with the array ``name``: shares in proportion to the exponentials of ``logs``.

    Step by step in columns of their own, so that no expression is repeated.
    """
    rows = rows.withColumn("_logs", logs).withColumn("_top", F.array_max("_logs"))
    rows = rows.withColumn("_each", F.transform("_logs", lambda x: F.exp(x - F.col("_top")))).withColumn("_sum", _total("_each"))
    return rows.withColumn(name, F.transform("_each", lambda x: x / F.col("_sum"))).drop("_logs", "_top", "_each", "_sum")


def with_shares(scored: DataFrame) -> DataFrame:
    """``scored`` with the array ``own``: P(language | text), all 0 without a trigram."""
    out = with_softmax(scored, F.transform("scores", lambda x: x * TEMPER), "own")
    return out.withColumn("own", F.when(F.col("trigrams") > 0, F.col("own")).otherwise(F.transform("own", lambda x: F.lit(0.0))))


class Fusion:
    """Statistics of the declared values, suffixes and hosts of scored rows.

    ``scored`` has host, domain, declared, suffix, scores and trigrams.  The
    tables of declared values and suffixes, and of domains, may be long as
    well; all of them are joined, none is collected.
    """

    def __init__(self, scored: DataFrame, languages: tuple[str, ...]):
        self.n = n = len(languages)
        rows = with_shares(scored).select("host", "domain", "declared", "suffix", *[F.col("own")[i].alias(f"p{i}") for i in range(n)])
        sums = [F.sum(f"p{i}").alias(f"p{i}") for i in range(n)]
        hosts = checkpointed(rows.groupBy("host", "domain").agg(*sums))
        total = [float(x or 0.0) for x in hosts.agg(*sums).first()]
        general = F.array(*[F.lit((t + 1) / (sum(total) + n)) for t in total])
        counts = F.array(*[F.col(f"p{i}") for i in range(n)])
        domains = hosts.groupBy("domain").agg(*sums).select("domain", counts.alias("seen")).withColumn("seen_sum", _total("seen"))
        smooth = F.zip_with("seen", general, lambda a, g: (a + PRIOR * g) / (F.col("seen_sum") + PRIOR))
        domains = checkpointed(domains.select("domain", smooth.alias("of_domain")))
        self.hosts = checkpointed(hosts.select("host", "domain", counts.alias("of_host")).join(domains, "domain"))
        self.values = {}
        for name in ("declared", "suffix"):
            found = checkpointed(rows.groupBy(name).agg(*sums))
            many = max(found.count(), 1)
            self.values[name] = checkpointed(found.select(F.col(name), F.array(*[F.log((F.col(f"p{i}") + VALUE) / (total[i] + VALUE * many)) for i in range(n)]).alias(f"of_{name}")))

    def posterior(self, scored: DataFrame) -> DataFrame:
        """``scored`` with the array ``p``: P(language | all evidence)."""
        out = with_shares(scored)
        for name, known in self.values.items():
            out = out.join(known, name, "left")
        out = out.join(self.hosts, ["host", "domain"], "left")
        # without the row's own share
        out = out.withColumn("left", F.zip_with("of_host", "own", lambda a, b: F.greatest(a - b, F.lit(0.0)))).withColumn("weight", _total("left"))
        logs = F.transform(
            F.sequence(F.lit(0), F.lit(self.n - 1)),
            lambda i: F.col("scores")[i] * TEMPER + F.col("of_declared")[i] + F.col("of_suffix")[i] + F.log((F.col("left")[i] + PRIOR * F.col("of_domain")[i]) / (F.col("weight") + PRIOR)),
        )
        return with_softmax(out, logs, "p").select(*scored.columns, "p")


def with_decision(rows: DataFrame, model: Model, confidence: float, far: float = FAR) -> DataFrame:
    """``rows`` (p, scores, trigrams) with ``found``, a language or 'und', and ``probability``."""
    rows = rows.withColumn("probability", F.array_max("p")).withColumn("best", F.array_position("p", F.col("probability")).cast("int"))
    least = F.element_at(F.array(*[F.lit(float(m - far)) for m in model.mean]), F.col("best"))
    known = (F.col("trigrams") < LEAST) | (F.element_at("scores", F.col("best")) >= F.col("trigrams") * least)
    sure = (F.col("trigrams") > 0) & (F.col("probability") >= confidence) & known
    return rows.withColumn("found", F.when(sure, F.element_at(F.array(*map(F.lit, model.languages)), F.col("best"))).otherwise("und")).drop("best")


#: What is not shown of a page, and single tags and entities.  A script, style or comment without an end goes on to the end of the page, so no place is scanned twice.
HIDDEN = r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>|&[#0-9A-Za-z]+;"


def identify_pages(pages: DataFrame, model: Model, page: str = "page_id", url: str = "url", html: str = "html", confidence: float = 0.5) -> DataFrame:
    """page, host, declared, lang, probability and text_lang of every page."""
    host = F.regexp_replace(host_of(F.col(url)), r":\d*$", "")
    named = lower_ascii(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), r"(?is)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    text = F.regexp_replace(F.col(html), HIDDEN, " ")
    scored = with_scores(pages, model, text, [F.col(page), host, named])
    suffix = F.regexp_extract("c1", r"([^.]*)$", 1)
    scored = scored.select("c0", F.col("c1").alias("host"), F.regexp_extract("c1", r"([^.]+\.[^.]+)$", 1).alias("domain"), F.col("c2").alias("declared"), suffix.alias("suffix"), "scores", "trigrams")
    scored = checkpointed(scored)
    fused = with_decision(Fusion(scored, model.languages).posterior(scored), model, confidence)
    alone = F.element_at(F.array(*map(F.lit, model.languages)), F.array_position("scores", F.array_max("scores")).cast("int"))
    return fused.select(F.col("c0").alias(page), "host", "declared", F.col("found").alias("lang"), F.round("probability", 6).alias("probability"), F.when(F.col("trigrams") > 0, alone).otherwise("und").alias("text_lang"))


def accepted_documents(docs: DataFrame, model: Model, text: str = "text", declared: str = "lang", source: str = "source", confidence: float = 0.5) -> DataFrame:
    """The documents with an identified language, with their own columns.

    The source serves as host; documents have no address, so the suffix says nothing.
    """
    names = docs.columns
    own = [F.col(f"`{c}`") for c in names]
    blank = F.lit("")
    seen = [F.coalesce(F.col(source).cast("string"), blank), blank, F.coalesce(F.col(declared).cast("string"), blank), blank]
    parts = ["host", "domain", "declared", "suffix"]

    def named(scored, first):
        return scored.select(*[f"c{i}" for i in range(first)], *[F.col(f"c{first + i}").alias(p) for i, p in enumerate(parts)], "scores", "trigrams")

    narrow = checkpointed(named(with_scores(docs, model, F.col(text), seen), 0), small=True)
    fusion = Fusion(narrow, model.languages)
    whole = named(with_scores(docs, model, F.col(text), [*own, *seen]), len(names))
    kept = with_decision(fusion.posterior(whole), model, confidence).filter("found <> 'und'")
    return checkpointed(kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]), small=True)
