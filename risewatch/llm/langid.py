"""Language identification by Bayesian fusion of evidence.

    log P(language | everything) = log P(text | language)            character trigrams, trained here on labelled rows
                                 + log P(declared markup | language)  how often pages of a language declare what
                                 + log P(address suffix | language)
                                 + log P(language | host)             smoothed towards its domain, that towards all rows
                                 + constant

The tables behind the last three come from grouped aggregation of the text model's own (soft) opinions over all rows; a row
is left out of its own host's counts. Text likelihoods are tempered: trigrams of a text repeat each other, so n of them
count as n * 200 / (n + 200). Short texts therefore lean on the other evidence, long ones on themselves.

A text in none of the trained languages, or noise, is rejected too: a further class competes with the best language by the
text's letters. Short texts hardly move its small prior.

Defined cases: a text without trigrams, or null, has no text evidence; if nothing else speaks for a language either (best
probability under `accept`), the row is rejected. Missing declarations, suffixes and hosts are values of their own. Ties go
to the language first in order. Repeated rows get equal results. Without any labelled row the one language is `und` and
every row is rejected. A document's own columns, whatever their names, are carried along as the struct `document`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risewatch.llm.shared import map_batches, settle

BINS = 1 << 16
TEMPER = 200.0
#: Labelled rows per language that train the text model (expected number; picked by hash): the documented bound.
TRAIN_ROWS = 4000
#: A row is accepted if its best language is at least this probable.
ACCEPT = 0.5
#: Prior odds that a text is in none of the trained languages; a row is rejected where its text makes that likelier than not.
FOREIGN = 1e-4
UNDETERMINED = "und"
#: Pseudo-rows by which a host leans on its domain, and a domain on all rows.
HOST_WEIGHT, DOMAIN_WEIGHT, EVIDENCE_WEIGHT = 5.0, 20.0, 2.0
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def _codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def trigram_bins(text: str | None) -> np.ndarray:
    """Bins of the character trigrams of the lower-cased text."""
    return _bins(_codes(text))


def _bins(codes: np.ndarray) -> np.ndarray:
    if len(codes) < 3:
        return np.zeros(0, np.uint32)
    x = codes[:-2] * _MIX[0] + codes[1:-1] * _MIX[1] + codes[2:] * _MIX[2]
    return (x ^ (x >> np.uint32(15))) & np.uint32(BINS - 1)


def _spelled(codes: np.ndarray) -> np.ndarray:
    """Trigrams of letters and blanks only: digits and signs are of no language, and so no sign of a foreign one."""
    plain = (codes >= 0xC0) | ((codes >= 0x61) & (codes <= 0x7A)) | (codes == 0x20)
    return plain[:-2] & plain[1:-1] & plain[2:]


class TextModel:
    """Log-likelihood of each trigram bin in each language: languages * 65,536 numbers, whatever the data.

    A further class stands for all that is none of these languages. What foreign text looks like to a language's model, the
    texts of the other languages show: its floor for a language lies half-way between the mean log-likelihood of a trigram
    of that language and of one of the other language that comes nearest (of one from evenly filled bins, if there is none).
    """

    def __init__(self, languages: list[str], logs: np.ndarray) -> None:
        self.languages, self.logs = languages, logs
        shares = np.exp(logs.astype(np.float64))
        means = shares.T @ logs / shares.sum(axis=0)[:, None]  # of the row's texts in the column's model
        own = np.diag(means).copy()
        np.fill_diagonal(means, -np.inf)
        self.floors = (own + np.maximum(means.max(axis=0), -np.log(BINS))) / 2

    def scores(self, text: str | None) -> tuple[np.ndarray, float]:
        """Tempered log-likelihoods of the languages, the best 0, and of the further class against the best language."""
        codes = _codes(text)
        bins, spelled = _bins(codes), _spelled(codes) if len(codes) >= 3 else np.zeros(0, bool)
        total, words = np.zeros(len(self.languages)), np.zeros(len(self.languages))
        for at in range(0, len(bins), 1 << 16):
            part = self.logs[bins[at : at + (1 << 16)]]
            total += part.sum(axis=0, dtype=np.float64)
            words += part[spelled[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        n, best = int(spelled.sum()), int(total.argmax())
        against = (self.floors[best] * n - words[best]) * TEMPER / (n + TEMPER)
        total *= TEMPER / (len(bins) + TEMPER)
        return total - total.max(), float(against)

    def evidence(self, text: str | None) -> np.ndarray:
        return self.scores(text)[0]


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", rows: int = TRAIN_ROWS) -> TextModel:
    """Counts trigrams of about `rows` labelled rows a language (all, where there are fewer), picked by a hash of the id."""
    data = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(label_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.lit(3), F.col(id_col)), F.lit(1 << 40)).alias("h"))
    share = data.groupBy("lang").agg((F.lit(float(rows)) / F.count("*") * (1 << 40)).alias("below"))
    picked = data.join(F.broadcast(share), "lang").where("h < below")  # a row per language

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs = batch.column(0).to_pylist()
        sums = {x: np.zeros(BINS, np.int64) for x in set(langs)}
        for lang, text in zip(langs, batch.column(1).to_pylist(), strict=True):
            sums[lang] += np.bincount(trigram_bins(text), minlength=BINS)
        out = [(lang, np.flatnonzero(n), n) for lang, n in sums.items()]
        return pa.record_batch(
            [pa.array([x for x, at, _ in out for _ in range(len(at))], pa.string()), pa.array(np.concatenate([at for _, at, _ in out]).astype(np.int32)), pa.array(np.concatenate([n[at] for _, at, n in out]))], names=["lang", "bin", "n"]
        )

    counted = map_batches(picked.select("lang", "text"), count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    # languages * BINS numbers at most
    found = counted.groupBy("lang").agg(F.collect_list("bin").alias("bin"), F.collect_list("n").alias("n")).collect()
    if not found:
        return TextModel([UNDETERMINED], np.zeros((BINS, 1), np.float32))
    found.sort(key=lambda x: x["lang"])
    logs = np.zeros((BINS, len(found)), np.float32)
    for k, row in enumerate(found):
        n = np.full(BINS, 0.05)
        n[row["bin"]] += row["n"]
        logs[:, k] = np.log(n / n.sum())
    return TextModel([x["lang"] for x in found], logs)


def with_evidence(df: DataFrame, model: TextModel, text: str) -> DataFrame:
    """Adds text_evidence array<double> and text_against double, see TextModel.scores. text: a column, or struct.field."""
    added = [T.StructField("text_evidence", T.ArrayType(T.DoubleType())), T.StructField("text_against", T.DoubleType())]
    schema = T.StructType([*df.schema.fields, *added])
    column, _, field = text.partition(".")
    at, names = df.columns.index(column), schema.names

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).field(field) if field else batch.column(at)
        found = [model.scores(x) for x in texts.to_pylist()]
        evidence = pa.array([x.tolist() for x, _ in found], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*batch.columns, evidence, pa.array([x for _, x in found], pa.float64())], names=names)

    return map_batches(df, each, schema)


def _opinion(n: int) -> list[Column]:
    """Probabilities by the text alone, languages alike at first."""
    e = [F.exp(F.col("text_evidence")[i]) for i in range(n)]
    total = sum(e[1:], e[0])
    return [x / total for x in e]


def _sums(scored: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    return scored.groupBy(*by).agg(F.array(*[F.sum(p) for p in _opinion(n)]).alias(name))


class Priors:
    """Tables for the evidence beside the text: counts of all, by declaration, suffix, domain and host."""

    def __init__(self, scored: DataFrame, n: int) -> None:
        """scored: declared, suffix, domain, host, text_evidence."""
        self.n = n
        opinions = settle(scored.groupBy("declared", "suffix", "domain", "host").agg(F.array(*[F.sum(p) for p in _opinion(n)]).alias("sums")))
        add = lambda by, name: opinions.groupBy(*by).agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(n)]).alias(name))
        total = F.array(*[F.sum(F.col("sums")[i]) for i in range(n)]).alias("all_sums")
        self.all = opinions.agg(total)
        self.declared, self.suffix = add(["declared"], "declared_sums"), add(["suffix"], "suffix_sums")
        self.host = add(["domain", "host"], "host_sums").join(add(["domain"], "domain_sums"), "domain").drop("domain")

    def fuse(self, scored: DataFrame, languages: list[str], accept: float) -> DataFrame:
        """Adds language, probability, text_language, accepted. Tables are joined by key; the planner sends only those to every task that its size limit allows."""
        n = self.n
        whole = [float(x or 0.0) for x in (self.all.first() or [[0.0] * n])[0] or [0.0] * n]  # one row
        rows = sum(whole) or 1.0
        share = [(x + 1.0) / (rows + n) for x in whole]
        joined = scored.join(self.declared, "declared", "left").join(self.suffix, "suffix", "left").join(self.host, "host", "left")
        own = _opinion(n)

        def likelihood(sums: str, i: int) -> Column:
            """P(value | language), smoothed towards the value's overall share."""
            of_value = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x) / rows
            return (F.col(sums)[i] + EVIDENCE_WEIGHT * of_value) / (whole[i] + EVIDENCE_WEIGHT)

        def host_prior(i: int) -> Column:
            domain_n = F.aggregate("domain_sums", F.lit(0.0), lambda a, x: a + x) - 1
            by_domain = (F.greatest(F.col("domain_sums")[i] - own[i], F.lit(0.0)) + DOMAIN_WEIGHT * share[i]) / (domain_n + DOMAIN_WEIGHT)
            host_n = F.aggregate("host_sums", F.lit(0.0), lambda a, x: a + x) - 1
            return (F.greatest(F.col("host_sums")[i] - own[i], F.lit(0.0)) + HOST_WEIGHT * by_domain) / (host_n + HOST_WEIGHT)

        floor = F.lit(1e-12)
        logs = [F.col("text_evidence")[i] + F.log(F.greatest(likelihood("declared_sums", i), floor)) + F.log(F.greatest(likelihood("suffix_sums", i), floor)) + F.log(F.greatest(host_prior(i), floor)) for i in range(n)]
        names = F.array(*map(F.lit, languages))
        out = joined.withColumn("_logs", F.array(*logs)).withColumn("_best", F.array_max("_logs"))
        out = out.withColumn("language", F.element_at(names, F.array_position("_logs", F.col("_best")).cast("int")))
        out = out.withColumn("text_language", F.element_at(names, F.array_position("text_evidence", F.array_max("text_evidence")).cast("int")))
        out = out.withColumn("probability", 1 / F.aggregate("_logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_best"))))
        known = F.col("text_against") + float(np.log(FOREIGN)) < 0
        out = out.withColumn("accepted", (F.col("probability") >= accept) & known & (F.col("language") != UNDETERMINED))
        return out.drop("text_against", "_logs", "_best", "declared_sums", "suffix_sums", "host_sums", "domain_sums", "text_evidence")


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def markup_language(html: Column) -> Column:
    """Primary tag of the language that the html element declares."""
    return F.lower(F.coalesce(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1), F.lit("")))


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<[^>]*>", " ")
    return F.regexp_replace(bare, "&[#0-9A-Za-z]+;", " ")


def _identify(rows: DataFrame, model: TextModel, accept: float, text: str) -> DataFrame:
    rows = rows.withColumns({"suffix": F.regexp_extract("host", r"([^.]*)$", 1), "domain": F.regexp_extract("host", r"([^.]*\.?[^.]*)$", 1)})
    # scored twice (once for the tables, once for the rows) so that texts are neither stored nor shuffled
    keys = with_evidence(rows, model, text).select("declared", "suffix", "domain", "host", "text_evidence")
    priors = Priors(keys, len(model.languages))
    return priors.fuse(with_evidence(rows, model, text), model.languages, accept).drop("suffix", "domain")


def identify_pages(pages: DataFrame, model: TextModel, accept: float = ACCEPT) -> DataFrame:
    """page_id, url, host, declared, language, text_language, probability, accepted of every page."""
    rows = pages.select("page_id", "url", visible_text(F.col("html")).alias("text"), markup_language(F.col("html")).alias("declared"), host_of(F.col("url")).alias("host"))
    return _identify(rows, model, accept, "text").select("page_id", "url", "host", "declared", "language", "text_language", "probability", "accepted")


def identify_documents(docs: DataFrame, model: TextModel, accept: float = ACCEPT, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """document (struct of all columns), language, text_language, probability, accepted; a document's source is its host and it declares nothing."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    rows = docs.select(whole, F.lit("").alias("declared"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("host"))
    return _identify(rows, model, accept, f"document.{text_col}").select("document", "language", "text_language", "probability", "accepted")
