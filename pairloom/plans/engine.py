"""The engine: pages to boxes, page texts, raw texts, sentences and aligned pairs, step by step.

Every step is a DataFrame and, with an ``output`` folder, a Parquet table, so that any suffix of the steps can be run
again from what is stored. Works are processed in parallel; one that fails keeps its error and harms no other.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import align, tfidf, vote, works
from ..sources import providers, readers, sinks

STEPS = ("ocr", "segment", "align")
#: Works up to which images are sifted by a broadcast; beyond, they are shuffled by work.
FEW = 100_000
log = logging.getLogger(__name__)


@dataclass
class CorpusEngine:
    """``recognisers``: (name, factory) or (name, factory, kind), see ``providers.recognise``. ``aligner``: a name, or a function of
    (source, target) sentences that returns the columns of ``align.positional``. ``exports``: tsv, text and xlsx."""

    spark: SparkSession
    output: str | None = None
    recognisers: list[tuple] = field(default_factory=list)
    corrector: Callable | None = None
    translator: Callable | None = None
    source_segmenter: Callable[[Column], Column] = T.segment
    target_segmenter: Callable[[Column], Column] = T.segment_plain
    aligner: str | Callable[[DataFrame, DataFrame], DataFrame] = "positional"
    first_pages: int | None = None
    strict: bool = False
    exports: tuple[str, ...] = ("tsv",)

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        """Stored in the output folder, or else in a scratch folder, so that no model runs twice."""
        return sinks.stage(df, f"{self.output}/{name}" if self.output else sinks.scratch(self.spark, name))

    def stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.output}/{name}")

    def _there(self, name: str) -> bool:
        return self.output is not None and readers.exists(self.spark, f"{self.output}/{name}")

    def _sifted(self, files: DataFrame, works_known: DataFrame, how: str) -> DataFrame:
        """Files joined with a table of works; the files' content stays where it is while works are few."""
        return files.join(F.broadcast(works_known) if works_known.count() <= FEW else works_known, "work_id", how)

    def first_images(self, files: DataFrame) -> DataFrame:
        """The first pages of each work by name: names are ranked, and files meet only the last name that is taken."""
        if self.first_pages is None:
            return files
        last = works.first_pages(files.select("work_id", "file_name"), self.first_pages).groupBy("work_id").agg(F.max("file_name").alias("last_name"))
        return self._sifted(files, last, "inner").filter(F.col("file_name") <= F.col("last_name")).drop("last_name")

    def unmatched(self, known: DataFrame, translations: DataFrame) -> DataFrame:
        """Works without a translation, which are skipped: stored, and named in a warning."""
        found = self._kept(works.unpaired(known.select("work_id").distinct(), translations.select("work_id")), "unmatched")
        some = [r["work_id"] for r in found.orderBy("work_id").limit(10).collect()]
        if some:
            log.warning("%d works have no translation and are skipped, first %s", found.count(), ", ".join(some))
        return found

    def source_texts(self, files: DataFrame) -> DataFrame:
        """work_id, text from page images (work_id, file_name, content)."""
        chosen = self.first_images(files)
        results = providers.recognise(chosen, self.recognisers, "file_name")
        texts = vote.vote_all(results, chosen, ["work_id", "file_name"], strict=self.strict)
        texts = texts.withColumn("text", providers.corrected(F.col("text"), self.corrector))
        return self._kept(works.joined(texts, ["work_id"], "file_name"), "source_raw")

    def target_texts(self, files: DataFrame) -> DataFrame:
        """work_id, text from translated documents (work_id, path, content)."""
        texts = works.joined(readers.pdf_pages(files), ["work_id"], "page_no")
        return self._kept(files.select("work_id").join(texts, "work_id", "left").withColumn("text", F.coalesce("text", F.lit(""))), "target_raw")

    def sentences(self, source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
        a = works.sentences(source.withColumn("text", T.unix_lines(F.col("text"))), ["work_id"], self.source_segmenter(F.col("text")))
        b = works.sentences(target, ["work_id"], self.target_segmenter(F.col("text")))
        both = (readers.persisted(x, ["work_id"]) for x in (a, b))
        return tuple(self._kept(x, name) for x, name in zip(both, ("source_sentences", "target_sentences"), strict=True))

    def align(self, source: DataFrame, target: DataFrame) -> DataFrame:
        if callable(self.aligner):
            return self._kept(self.aligner(source, target), "pairs")
        if self.aligner == "positional":
            return self._kept(align.positional(source, target), "pairs")
        if self.aligner != "dynamic":
            raise ValueError(f"no aligner is named {self.aligner!r}")
        meant = self._kept(providers.translated(source, "work_id", self.translator), "translated")
        both = meant.select("work_id", F.lit("source").alias("side"), "pos", F.col("sentence_tr").alias("sentence"))
        both = both.unionByName(target.select("work_id", F.lit("target").alias("side"), "pos", "sentence"))
        return self._kept(align.dynamic(source, target, tfidf.cosines(tfidf.weights(both))), "pairs")

    def export(self, pairs: DataFrame) -> None:
        """The files of ``exports`` beside the tables."""
        if "tsv" in self.exports:
            sinks.pairs_tsv(pairs, f"{self.output}/pairs_tsv", ["work_id"])
        if "xlsx" in self.exports:
            sinks.stage(sinks.workbooks(pairs), f"{self.output}/pairs_xlsx")
        if "text" in self.exports:
            for name in ("source_raw", "target_raw"):
                if self._there(name):
                    sinks.raw_files(self.stored(name), f"{self.output}/text/{name}")
            for name in ("source_sentences", "target_sentences"):
                sinks.sentence_files(self.stored(name), f"{self.output}/text/{name}")

    def run(self, source_folder: str | None = None, target_folder: str | None = None, steps: tuple[str, ...] = STEPS, global_work: bool = False) -> DataFrame | None:
        """Runs the steps in order; those left out are read from ``output``. Returns the last step's table.

        A folder that is not there, or an alignment without sentences, ends the run with a warning and None; works whose raw text is
        not stored have "".
        """
        for folder, needed in ((source_folder, "ocr" in steps), (target_folder, "segment" in steps or "ocr" in steps and not global_work)):
            if needed and (folder is None or not readers.exists(self.spark, folder)):
                log.warning("the folder %s does not exist", folder)
                return None
        source = target = out = None
        if "ocr" in steps:
            files = readers.image_files(self.spark, source_folder)
            if not global_work:  # works without a translation are skipped
                have = readers.translations(self.spark, target_folder, exact=True).select("work_id").distinct()
                self.unmatched(files, have)
                files = self._sifted(files, have, "left_semi")
            source = out = self.source_texts(files)
        if "segment" in steps:
            source = source if source is not None else self._raw(source_folder)
            target = self.target_texts(readers.translations(self.spark, target_folder, exact=not global_work))
            if global_work:
                source, target = global_text(source), global_text(target)
            else:
                target = works.paired(target, source.select("work_id"))
                source = source.join(target.select("work_id"), "work_id", "left_semi")
            source, target = self.sentences(source, target)
            out = source
        if "align" in steps:
            if "segment" not in steps:
                if not (self._there("source_sentences") and self._there("target_sentences")):
                    log.warning("no sentences are stored; run the segment step first")
                    return None
                source, target = self.stored("source_sentences"), self.stored("target_sentences")
            out = self.align(source, target)
            if self.output:
                self.export(out)
        return out

    def _raw(self, source_folder: str | None) -> DataFrame:
        """The stored raw texts; works of the folder without one have ""."""
        if self._there("source_raw"):
            texts = self.stored("source_raw")
        else:
            log.warning("no raw texts are stored; the source side is empty")
            texts = self.spark.createDataFrame([], "work_id string, text string")
        if source_folder is None or not readers.exists(self.spark, source_folder):
            return texts
        return readers.works(self.spark, source_folder).join(texts, "work_id", "left").withColumn("text", F.coalesce("text", F.lit("")))

    def counts(self, source: DataFrame, target: DataFrame, pairs: DataFrame) -> DataFrame:
        """work_id, n_source, n_target, n_pairs: what a log of a run tells of each work."""
        return step_counts(source, target, pairs, "work_id")


def step_counts(source: DataFrame, target: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    parts = [df.groupBy(key).agg(F.count("*").alias(name)) for name, df in (("n_source", source), ("n_target", target), ("n_pairs", pairs))]
    out = parts[0].join(parts[1], key, "full").join(parts[2], key, "full")
    return out.select(key, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_source", "n_target", "n_pairs")))


def global_text(texts: DataFrame) -> DataFrame:
    """All works as one, in the order of their names: what the global mode is. It is one value, so of bounded corpora."""
    one = works.joined(texts, [], "work_id") if texts.columns else texts
    return one.select(F.lit("global").alias("work_id"), F.when(F.length("text") > 0, F.concat("text", F.lit("\n"))).otherwise(F.lit("")).alias("text"))
