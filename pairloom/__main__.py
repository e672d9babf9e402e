"""Builds a parallel corpus from the command line: ``python -m pairloom --run_all --recogniser text=mine:factory``.

Steps that are not asked for are read from the output folder; without any step all are run. Recognisers are given
as NAME=MODULE:FACTORY, or NAME/KIND=MODULE:FACTORY with the kinds text, boxes, vision and vertical, and vote in the order given. A
corrector, a translator and a segmenter of the target side are given as MODULE:FACTORY.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable

from pyspark.sql import SparkSession

from .plans import settings
from .plans.engine import STEPS, CorpusEngine
from .sources import providers


def factory(place: str) -> Callable:
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    own = settings.load()
    p = argparse.ArgumentParser(prog="pairloom", description=__doc__)
    p.add_argument("--han_dir", default=own.source_dir, help="folder with one folder of page images per work")
    p.add_argument("--viet_dir", default=own.target_dir, help="folder of translated documents")
    p.add_argument("--output_dir", default=own.output_dir)
    for step, name in zip(STEPS, ("ocr", "seg", "align"), strict=True):
        p.add_argument(f"--step_{name}", dest="steps", action="append_const", const=step)
    p.add_argument("--run_all", action="store_true", help="all steps; also if none is named")
    p.add_argument("--first-n-images", type=int, help="pages of each work that are recognised at most")
    p.add_argument("--global-concat", action="store_true", help="all works as one")
    p.add_argument("--aligner", choices=("positional", "dynamic"), default="positional")
    p.add_argument("--recogniser", action="append", default=[], metavar="NAME[/KIND]=MODULE:FACTORY")
    for name in ("corrector", "translator", "segmenter"):
        p.add_argument(f"--{name}", metavar="MODULE:FACTORY")
    p.add_argument("--export", action="append", choices=("tsv", "text", "xlsx"), help="files beside the tables; tsv if none is named")
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    own = parser().parse_args(arguments)
    steps = STEPS if own.run_all or not own.steps else tuple(s for s in STEPS if s in own.steps)
    named = ((name.partition("/"), place) for name, _, place in (x.partition("=") for x in own.recogniser))
    recognisers = [(name, factory(place), kind or "text") for (name, _, kind), place in named]
    corrector, translator, segmenter = (factory(x) if x else None for x in (own.corrector, own.translator, own.segmenter))
    spark = spark or SparkSession.builder.appName("pairloom").getOrCreate()
    engine = CorpusEngine(spark, own.output_dir, recognisers, aligner=own.aligner, first_pages=own.first_n_images, corrector=corrector, translator=translator)
    if segmenter:
        engine.target_segmenter = providers.segmented(segmenter)
    if own.export:
        engine.exports = tuple(own.export)
    return 0 if engine.run(own.han_dir, own.viet_dir, steps, own.global_concat) is not None else 1


if __name__ == "__main__":
    raise SystemExit(main())
