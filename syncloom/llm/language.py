"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the text (naive Bayes over hashed byte trigrams, tempered so that a long text doesn't drown the
rest), the declared markup language, the address suffix and the host. P(declared | language), P(language | suffix) and P(language | host) come from
grouped counts over all rows of the text model's own decisions; the host prior is smoothed towards its suffix's and that one towards
all rows'. A row's own decision is left out of every count that judges it. The class "und" finds all trigrams equally unlikely: text that no
language explains better is und.

Scale: one pass over the texts for the counts and one for the scores; only counts are shuffled, with map-side combining. The tables of hosts,
suffixes and declared values are broadcast only if their counted size allows, else joined by a shuffle. The model is fitted on the driver from
a bounded sample: at most SAMPLE_ROWS different labelled texts of at most SAMPLE_CHARS characters, in equal parts of all languages (a language
with fewer texts gives all). The model knows the MOST_LANGUAGES labels with most rows, which bounds its table.

Defined results: null, empty or letterless text is und, with posterior 1; null evidence is left out; of equal likelihoods the first language in
order wins; repeated rows count each, in the sample once; an empty table gives no rows; extra columns are kept by `identified`, whose own
columns begin with lid_ (such columns of the input are replaced).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, checkpoint, fold, join_checked, map_arrow, text_chunks, with_fields
from .textops import byte_ngrams, lower_latin

BITS = 14
UND = "und"
SAMPLE_ROWS, SAMPLE_CHARS, MOST_LANGUAGES, SEED = 4_000, 20_000, 256, 5
#: Bytes of the sample that the driver looks at together.
FIT_BYTES = 1 << 18
#: `documents` are fitted on without those whose crc32 of the id, mod FOLDS, is HELD_OUT.
FOLDS, HELD_OUT = 4, 2
#: Trigrams of a text that count in full; the log likelihood of a longer one is scaled down to so many.
EVIDENCE = 60
#: Rows that a parent's prior is worth when it smooths a host's or suffix's counts; and when it smooths P(declared | language).
HOST_ROWS, DECLARED_ROWS = 20.0, 5.0
#: A document is rejected as und, or below this posterior.
LEAST_POSTERIOR = 0.5
#: Log probability of any trigram under und: a fifth of what even odds over all would give, so that names, codes and shouting don't make a text und.
UND_LOG = -BITS * np.log(2) - np.log(5)
#: Share of und before any evidence.
UND_PRIOR = 0.01


class TextModel:
    """log P(trigram | language), languages in order, und last."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def likelihoods(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean log likelihood of a text's trigrams for each language, and the number of its trigrams with a letter."""
        n = len(offsets) - 1
        low = lower_latin(data)
        grams, text = byte_ngrams(low, offsets, 3, BITS)
        letter = ((low >= 97) & (low <= 122)) | (low >= 128)
        whole = len(low) - 2
        if whole > 0:
            inside = np.repeat(np.arange(n), np.diff(offsets))
            has = (letter[:whole] | letter[1 : whole + 1] | letter[2:])[inside[:whole] == inside[2:]]
            grams, text = grams[has], text[has]
        counts = np.bincount(text, minlength=n)
        total = np.stack([np.bincount(text, weights=row[grams], minlength=n) for row in self.table], axis=1) if len(grams) else np.zeros((n, len(self.table)))
        return total / np.maximum(counts, 1)[:, None], counts


def fit_text_model(labelled: DataFrame, text_col: str, label_col: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> TextModel:
    """Trigram counts by label from a bounded sample picked by a hash of the text."""
    usable = labelled.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text")).filter(F.col("label").isNotNull() & F.length("text").between(1, chars))
    known = [r["label"] for r in usable.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MOST_LANGUAGES).collect()]
    sample = bounded_sample(usable, rows, SEED, known)
    languages = sorted(known) or ["und0"]
    counts = np.zeros((len(languages), 1 << BITS))
    code = np.searchsorted(languages, np.array(sample.column("label").to_pylist(), dtype=object)) if sample.num_rows else np.zeros(0, int)
    at = 0
    for batch in sample.to_batches():
        for i, j, data, offsets in text_chunks(batch, "text", FIT_BYTES):
            grams, text = byte_ngrams(lower_latin(data), offsets, 3, BITS)
            np.add.at(counts, (code[at + i : at + j][text], grams), 1)
        at += batch.num_rows
    smoothed = counts + 0.05
    table = np.log(smoothed / smoothed.sum(1, keepdims=True))
    return TextModel([*languages, UND], np.vstack([table, np.full(1 << BITS, UND_LOG)]).astype(np.float64))


def _counts_of(column: pa.Array, size: int) -> np.ndarray:
    """An array column without nulls as a matrix."""
    return np.asarray(column.flatten()).reshape(-1, size)


def _text_best(model: TextModel, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch, "lid_text"):
                mean, counts = model.likelihoods(data, offsets)
                best = np.where(counts > 0, mean.argmax(1), len(model.languages) - 1)
                kept = batch.slice(i, j - i).select(columns)
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(best.astype(np.int32))], names=[*columns, "lid_best"])

    return run


def identified(docs: DataFrame, model: TextModel, text: Column, declared: Column | None = None, host: Column | None = None, suffix: Column | None = None, least: float = LEAST_POSTERIOR) -> DataFrame:
    """docs with lid_lang, lid_posterior, lid_text_lang (by the text alone) and lid_keep (not und, and at least `least` sure)."""
    none = F.lit(None).cast("string")
    docs = docs.drop(*[c for c in docs.columns if c.lower().startswith("lid_")])
    given = docs.withColumns({"lid_text": text, "lid_declared": none if declared is None else declared, "lid_host": none if host is None else host, "lid_suffix": none if suffix is None else suffix})
    names = model.languages
    size = len(names)

    keys = ["lid_declared", "lid_host", "lid_suffix"]
    best = map_arrow(given.select("lid_text", *keys), _text_best(model, keys), "lid_declared string, lid_host string, lid_suffix string, lid_best int")
    counts = checkpoint(best.groupBy(*keys, "lid_best").agg(F.count(F.lit(1)).alias("rows")))
    per = F.array(*[F.sum(F.when(F.col("lid_best") == c, F.col("rows")).otherwise(0)).cast("double") for c in range(size)])
    total = np.array(counts.agg(per.alias("own")).first()["own"], dtype=object)
    total = np.array([0.0 if x is None else float(x) for x in total])
    tables = {}
    for key, given_evidence in (("lid_declared", declared), ("lid_host", host), ("lid_suffix", suffix)):
        nothing = F.array(*[F.lit(0.0)] * size)
        if given_evidence is None:
            given = given.withColumn(f"{key}_own", nothing)
            continue
        tables[key] = checkpoint(counts.filter(F.col(key).isNotNull()).groupBy(key).agg(per.alias(f"{key}_own")))
        given = join_checked(given, tables[key], key, "left").withColumn(f"{key}_own", F.coalesce(f"{key}_own", nothing))
    kinds = 1 + (tables["lid_declared"].count() if declared is not None else 0)
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_names = [*kept, "lid_lang", "lid_posterior", "lid_text_lang", "lid_keep"]
        labels = np.array(names, dtype=object)
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch, "lid_text"):
                part = batch.slice(i, j - i)
                column = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023, E731
                mean, n = model.likelihoods(data, offsets)
                alone = np.where(n > 0, mean.argmax(1), size - 1)
                own = np.zeros((j - i, size))
                own[np.arange(j - i), alone] = 1  # what the row itself adds to counts
                prior = np.maximum(total - own, 0) + 1
                prior[:, -1] = 0
                prior *= (1 - UND_PRIOR) / prior.sum(1, keepdims=True)
                prior[:, -1] = UND_PRIOR
                for key in ("lid_suffix", "lid_host"):  # from the wider to the narrower
                    others = np.maximum(_counts_of(column(f"{key}_own"), size) - own, 0)
                    prior = (others + prior * HOST_ROWS) / (others.sum(1, keepdims=True) + HOST_ROWS)
                log = mean * np.minimum(n, EVIDENCE)[:, None] + np.log(np.maximum(prior, 1e-12))
                others = np.maximum(_counts_of(column("lid_declared_own"), size) - own, 0)
                likely = (others + DECLARED_ROWS / kinds) / (np.maximum(total - own, 0) + DECLARED_ROWS)
                likely[:, -1] = 1 / kinds  # und explains every declaration alike
                log += np.where(np.asarray(column("lid_declared").is_valid())[:, None], np.log(likely), 0)
                log -= log.max(1, keepdims=True)
                p = np.exp(log)
                p /= p.sum(1, keepdims=True)
                top = np.where(n > 0, p.argmax(1), size - 1)
                sure = np.where(n > 0, p[np.arange(j - i), top], 1.0)
                keep = (top != size - 1) & (sure >= least)
                added = [pa.array(labels[top], pa.string()), pa.array(np.round(sure, 6)), pa.array(labels[alone], pa.string()), pa.array(keep)]
                yield pa.RecordBatch.from_arrays([*[column(c) for c in kept], *added], names=out_names)

    ordered = given.select(*kept, "lid_text", "lid_declared", *[f"{k}_own" for k in keys])
    schema = with_fields(docs.schema, lid_lang="string", lid_posterior="double", lid_text_lang="string", lid_keep="boolean")
    return map_arrow(ordered, run, schema)


def identify_documents(docs: DataFrame) -> DataFrame:
    """`docs` with the lid_ columns: `lang` is the declared language, `source` stands for the host.

    `lang` is the training label, too, so the text model is fitted without the held-out fold: what it says there isn't learnt from the same rows.
    """
    model = fit_text_model(docs.filter(fold("doc_id", FOLDS) != HELD_OUT), "text", "lang")
    return identified(docs, model, F.col("text"), F.col("lang"), F.col("source"))


_BLOCK = re.compile(r"<(script|style|nav)\b|<!--", re.IGNORECASE | re.ASCII)
_CLOSERS = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE | re.ASCII) for name in ("script", "style", "nav")} | {"": re.compile("-->")}
_HTML = re.compile("<html", re.IGNORECASE | re.ASCII)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.IGNORECASE | re.ASCII)


def without_markup(html: str) -> str:
    """The text of a page: script, style and nav elements, comments and tags are a space each. What is never closed is text.

    One forward scan: an opener's end is looked up among the closers, which are found once, and the first kind that has no closer left isn't looked for again.
    """
    ends = {name: [m.span() for m in closer.finditer(html)] for name, closer in _CLOSERS.items()}
    at, out = dict.fromkeys(ends, 0), []
    begin = 0
    for m in _BLOCK.finditer(html):
        if m.start() < begin:
            continue
        name = (m.group(1) or "").lower()
        own, k = ends[name], at[name]
        while k < len(own) and own[k][0] < m.end():
            k += 1
        at[name] = k
        if k < len(own):
            out += [html[begin : m.start()], " "]
            begin = own[k][1]
    whole = "".join([*out, html[begin:]])
    parts, begin = [], 0
    while (low := whole.find("<", begin)) >= 0 and (high := whole.find(">", low)) >= 0:
        parts += [whole[begin:low], " "]
        begin = high + 1
    return "".join([*parts, whole[begin:]])


def declared_language(html: str) -> str | None:
    """The two or three letters of the lang attribute of an html tag, lower case; the first that has one. Each tag is read once, to its end."""
    at = 0
    while m := _HTML.search(html, at):
        end = html.find(">", m.end())
        end = len(html) if end < 0 else end
        if found := _LANG.search(html, m.end(), end):
            return found.group(1).lower()
        at = end
    return None


def identify_pages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """Pages with the lid_ columns: text without markup, the html element's lang, the host and its last label."""
    from .reputation import url_host

    pages = pages.drop("_lid_bare", "_lid_markup")
    kept = pages.columns
    host = F.nullif(url_host(F.col("url")), F.lit(""))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(batch.schema.get_field_index("html")).to_pylist()
            bare, declared = [None if h is None else without_markup(h) for h in html], [None if h is None else declared_language(h) for h in html]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bare, pa.string()), pa.array(declared, pa.string())], names=[*kept, "_lid_bare", "_lid_markup"])

    model = fit_text_model(labelled, "text", "lang")
    given = map_arrow(pages, read, with_fields(pages.schema, _lid_bare="string", _lid_markup="string"))
    return identified(given, model, F.col("_lid_bare"), F.col("_lid_markup"), host, F.substring_index(host, ".", -1)).drop("_lid_bare", "_lid_markup")
