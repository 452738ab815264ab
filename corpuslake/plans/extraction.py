"""The main job: a vertical to the table of text units and the table of n-gram frequencies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.config import NgramSpec, SelfJoin, StructureSpec
from corpuslake.functions.modifiers import modifier_chain
from corpuslake.operators import ngrams as ng
from corpuslake.operators import structure as st
from corpuslake.operators import tokens as tk
from corpuslake.operators.gaps import gap_rows
from corpuslake.operators.ordered import Order
from corpuslake.operators.units import duplicate_items
from corpuslake.sinks import snapshots
from corpuslake.sinks import tables as sink
from corpuslake.sources.vertical import read_lines, resolve_paths, struct_events, token_column, token_lines
from corpuslake.stages import Stages

ORDER = Order()


@dataclass(frozen=True)
class Extraction:
    units: DataFrame
    frequencies: DataFrame | None
    errors: DataFrame
    n_tokens: int | None
    # For an ARF: the n-grams with their place among the tokens counted.
    occurrences: DataFrame | None = None
    counted: int | None = None


def build(
    lines: DataFrame,
    spec: StructureSpec,
    stages: Stages,
    ngrams: NgramSpec | None = None,
    join: SelfJoin | None = None,
    token_filter: Column | None = None,
    filter_attrs: Sequence[str] = (),
    n_tokens: int | None = None,
    order: Order = ORDER,
    poscount_scope: str = "atom",
    keep_bare: bool = True,
    max_errors: int | None = None,
) -> Extraction:
    """Both tables of the lines of one corpus.

    ``token_filter`` is a predicate on ``cols`` (the token's columns) and the structural attributes
    named in ``filter_attrs``; only tokens that pass are counted, in every part of the result. Structures with more than
    ``max_errors`` errors end the job at the stage that finds them, before units and n-grams are made.
    """
    keep = stages.keep

    def budgeted():
        return keep if max_errors is None else st.Budget(keep, max_errors)

    named = token_columns(ngrams)
    tokens = token_lines(lines).select(*order.place, "cols")
    if token_filter is None:
        events = keep(st.events_with_token_counts(lines, order, keep))
    else:
        events = keep(struct_events(lines).withColumn("tok", F.lit(0).cast("long")))
        if filter_attrs:
            tokens = tk.tokens_in_context(tokens, st.resolve(events, spec, order, budgeted()), filter_attrs, order)
        tokens = keep(tokens.where(token_filter).select(*order.place, *[e.alias(c) for c, e in named.items()]))
        events = keep(tk.accepted_before_tags(tokens, events.drop("tok"), order))
    resolved = st.resolve(events, spec, order, budgeted())
    marked = keep(st.mark_units(resolved, spec, join, order))
    errors = [st.structure_errors(events if spec.nested else resolved, spec, order, keep), st.tag_errors(events, order)]
    if join:
        errors.append(st.item_id_errors(resolved, spec, join, order))
    frequencies = occurrences = counted = None
    if ngrams:
        if token_filter is None:
            tokens = tokens.select(*order.place, *[e.alias(c) for c, e in named.items()])
        indexed = keep(tk.indexed_tokens(tokens, marked, order))
        counted = indexed.count()
        n_tokens = counted if n_tokens is None else n_tokens
        grams = ng.from_rows(indexed, ngrams.size, {c: F.col(c) for c in ngrams.names})
        keys = ["corpus_id", *ngrams.names]
        if ngrams.arf:
            occurrences = grams
            counts = ng.count_with_arf(grams.withColumn("corpus_size", F.lit(n_tokens).cast("long")), keys, counted)
        else:
            counts = ng.count_ngrams(grams, keys)
        frequencies = ng.frequency_table(counts, ngrams)
    units = st.unit_rows(marked, spec, join, order, poscount_scope, keep_bare)
    return Extraction(units, frequencies, st.all_errors(*errors), n_tokens, occurrences, counted)


def token_columns(ngrams: NgramSpec | None) -> dict[str, Column]:
    if ngrams is None:
        return {}
    return {c.name: modifier_chain(c.modifier)(token_column(c.idx)) for c in ngrams.columns}


def extract(
    spark: SparkSession,
    target: sink.Target,
    spec: StructureSpec,
    file: str | None = None,
    files: Sequence[str] | None = None,
    append: bool = False,
    encoding: str = "utf-8",
    max_errors: int = 0,
    date_attr: str | None = None,
    remove_before: dt.date | str | None = None,
    repeat: str = "refuse",
    **options,
) -> int:
    """Reads a vertical and writes its tables; returns the number of errors tolerated.

    Without ``append``, the tables of units and of n-grams are replaced, both. ``append`` adds the corpus to existing tables, after
    removing text units older than ``remove_before`` by ``date_attr``. The same input of a corpus again is refused
    (``repeat="refuse"``), or the corpus is replaced by it (``repeat="replace"``). All changes count at once, when a snapshot names
    them; nothing changes if the job fails, if the input has more than ``max_errors`` errors (a tag in error is left out), or if
    another job has changed the tables meanwhile. More text of a stored corpus follows the text before; its n-grams must have an ARF
    if those stored have one, which is then that of the whole corpus. ``options`` are those of ``build``.
    """
    if (date_attr is None) != (remove_before is None):
        raise ValueError("a moving window needs both date_attr and remove_before")
    if remove_before is not None and not append:
        raise ValueError("a moving window is for append only")
    if repeat not in ("refuse", "replace"):
        raise ValueError(f"repeat is refuse or replace, not {repeat}")
    if append:
        sink.require_existing(spark, target)
    paths = resolve_paths(spark, file, files)
    before, source = sink.snapshot(spark, target), sink.input_key(spark, paths)
    known = append and any(source in p.sources for p in before.parts if target.corpus in p.corpora)
    if known and repeat == "refuse":
        raise sink.Repeated(f"this input of {target.corpus} is stored already")
    lines = read_lines(spark, paths, target.corpus, encoding)
    stages = Stages(spark)
    try:
        made = build(lines, spec, stages, max_errors=max_errors, **options)
        errors = st.check_errors(made.errors, max_errors)
        units = stages.keep(made.units)
        add, drop = [], []
        if not append:
            drop += before.of_any((sink.UNITS, *sink.COUNTED))
        elif known:
            add, drop = sink.corpus_parts(spark, target, before, target.corpus)
        left = before.with_parts(add, drop)
        if remove_before is not None:
            more, less, _ = sink.older_parts(spark, target, left, date_attr, remove_before)
            add, drop = [p for p in add if p not in less] + more, drop + less
            left = before.with_parts(add, drop)
        if options.get("join"):
            named = units.select("item_id", "corpus_id")
            if left.of(sink.UNITS):
                named = named.unionByName(sink.read(spark, target, target.units, left).select("item_id", "corpus_id"))
            if twice := duplicate_items(named).take(1):
                raise ValueError(f"item id {twice[0]['item_id']} is not unique in {twice[0]['corpus_id']}")
        add.append(sink.units_part(units, target, [source]))
        if made.occurrences is not None:
            ngrams = options["ngrams"]
            gaps = gap_rows(made.occurrences, ["corpus_id", *ngrams.names], made.counted)
            sizes = spark.createDataFrame([(target.corpus, made.counted, made.n_tokens)], "corpus_id string, tokens long, corpus_size long")
            more, less = sink.arf_parts(gaps, sizes, ngrams, target, left, [source])
            add, drop = [p for p in add if p not in less] + more, drop + less
        elif made.frequencies is not None:
            more, less = sink.merged_frequencies(spark, stages.keep(made.frequencies), target, left, [source])
            add, drop = [p for p in add if p not in less] + more, drop + less
        snapshots.publish(spark, target.log, before.with_parts(add, drop))
    finally:
        stages.drop()
    return errors
