"""Registered queries: each takes (spark, folder of the given tables) and returns a DataFrame."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import reduce
from itertools import cycle

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.config import NgramSpec, SelfJoin, StructureSpec, VertColumn
from corpuslake.functions import feat_sets, feats_key, item_id, modifier_chain, ngram_hash
from corpuslake.operators import livetokens as lt
from corpuslake.operators import ngrams as ng
from corpuslake.operators import search
from corpuslake.operators import structure as st
from corpuslake.operators import tokens as tk
from corpuslake.operators import units
from corpuslake.operators.bitmaps import SearchIndex, bitmaps_of, entries_of, sorted_bitmaps
from corpuslake.operators.gaps import gap_rows
from corpuslake.operators.structure import TooManyErrors
from corpuslake.plans import corpora as cp
from corpuslake.plans.extraction import extract
from corpuslake.sinks import tables as sink
from corpuslake.sources.charsets import any_charset
from corpuslake.sources.tables import corpus_sizes, text_lengths, with_token_offsets
from corpuslake.sources.vertical import read_lines, resolve_paths, struct_events, token_column, token_lines
from corpuslake.stages import Stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__.strip("_")] = fn
    return fn


def _rules(*columns: VertColumn, size: int = 1) -> tuple[NgramSpec, dict]:
    spec = NgramSpec(size, columns)
    return spec, ng.modified(spec, cp.COLUMNS)


# --- n-grams ----------------------------------------------------------------------------------


@query
def unigram_counts(spark, sf_dir):
    spec, rules = _rules(VertColumn(0, "toLower"))
    counts = ng.count_ngrams(ng.from_arrays(cp.document_tokens(spark, sf_dir), 1, rules), ["corpus_id", "col0"])
    return counts.select("corpus_id", "col0", ngram_hash([F.col("col0")]).alias("hash_id"), "count")


def _bigram_arf(spark, sf_dir, **options):
    spec, rules = _rules(VertColumn(0, "", "lemma"), size=2)
    texts = cp.document_texts(spark, sf_dir)
    lengths = Stages(spark).keep(text_lengths(cp.tokenised(texts), cp.TEXT_ORDER))
    sizes = corpus_sizes(lengths, ["corpus_id"], F.col("n"))
    placed = sizes.attach(cp.tokenised(with_token_offsets(texts, cp.TEXT_ORDER, lengths)), ["doc_id"])
    occurrences = ng.from_arrays(placed, 2, rules, ["corpus_id", "corpus_size"], base="base")
    counts = ng.count_with_arf(occurrences, ["corpus_id", "col0"], sizes.total("corpus_size"), **options)
    return ng.frequency_table(counts, spec)


@query
def bigram_arf(spark, sf_dir):
    return _bigram_arf(spark, sf_dir)


@query
def bigram_arf_hot(spark, sf_dir):
    """The same with n-grams split that one sort of a large corpus could not hold."""
    return _bigram_arf(spark, sf_dir, hot_run=200)


@query
def bigram_arf_append(spark, sf_dir):
    """The same of corpora stored in two halves; the second is appended without reading the first one's tokens."""
    stages, (spec, rules) = Stages(spark), _rules(VertColumn(0, "", "lemma"), size=2)
    target, texts = sink.Target(stages.folder(), "documents"), cp.document_texts(spark, sf_dir)
    middle = cp.documents(spark, sf_dir).agg(F.floor((F.min("doc_id") + F.max("doc_id")) / 2)).first()[0] or 0
    for k, half in enumerate((F.col("doc_id") <= middle, F.col("doc_id") > middle)):
        some = texts.where(half)
        lengths = stages.keep(text_lengths(cp.tokenised(some), cp.TEXT_ORDER))
        sizes = lengths.groupBy("corpus_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).withColumn("corpus_size", F.col("tokens"))
        total = lengths.agg(F.sum("n")).first()[0] or 0
        placed = cp.tokenised(with_token_offsets(some, cp.TEXT_ORDER, lengths))
        occurrences = ng.from_arrays(placed, 2, rules, base="base")
        sink.write_arf(gap_rows(occurrences, ["corpus_id", "col0"], total), sizes, spec, target, append=k > 0)
    return sink.read(spark, target, target.frequencies).withColumn("ngram_size", F.col("ngram_size").cast("int"))


@query
def trigram_counts(spark, sf_dir):
    _, rules = _rules(VertColumn(0, "toLower"), size=3)
    occurrences = ng.from_arrays(cp.conversation_tokens(spark, sf_dir), 3, rules)
    return ng.count_ngrams(occurrences, ["corpus_id", "col0"])


def _ipm(spark, sf_dir, **options):
    """Every token is a unigram, so the counts add up to the sizes."""
    _, rules = _rules(VertColumn(0, "toLower"))
    counts = ng.count_ngrams(ng.from_arrays(cp.document_tokens(spark, sf_dir), 1, rules), ["corpus_id", "col0"])
    counts = Stages(spark).keep(counts)
    sized = corpus_sizes(counts, ["corpus_id"], F.col("count"), **options).attach(counts, ["col0"])
    return sized.select("corpus_id", "col0", "count", ng.per_million(F.col("count"), F.col("corpus_size")).alias("ipm"))


@query
def ngram_ipm(spark, sf_dir):
    return _ipm(spark, sf_dir)


@query
def ngram_ipm_many(spark, sf_dir):
    """The same by the join for more corpora than are broadcast."""
    return _ipm(spark, sf_dir, at_most=1)


_MULTI = (VertColumn(0, ""), VertColumn(1, "", "lemma"), VertColumn(2, "penn"))


def _multi_column_counts(spark, sf_dir):
    spec, rules = _rules(*_MULTI, size=2)
    return spec, ng.count_from_arrays(cp.document_tokens(spark, sf_dir), 2, rules)


@query
def ngram_multi_column(spark, sf_dir):
    spec, counts = _multi_column_counts(spark, sf_dir)
    return ng.frequency_table(counts, spec)


@query
def ngram_columns_fold(spark, sf_dir):
    """The columns of the multi-column n-grams visited in order, with an accumulator: numbered texts, and how many columns differ from the first."""
    spec, counts = _multi_column_counts(spark, sf_dir)
    text = ng.fold_columns(spec.names, F.lit(""), lambda acc, t, i: F.concat(acc, F.lit(f"{i}:"), t, F.lit(";")))
    other = ng.fold_columns(spec.names, F.lit(0), lambda acc, t, i: acc + (t != F.col(spec.names[0])).cast("int"))
    return counts.select("corpus_id", text.alias("texts"), other.alias("differing"), "count")


@query
def ngram_columns_long(spark, sf_dir):
    """Every column text of the multi-column n-grams as a row, summed by column and text."""
    spec, counts = _multi_column_counts(spark, sf_dir)
    rows = ng.long_columns(counts, spec.names, ["corpus_id", "count"])
    return rows.groupBy("corpus_id", "col_idx", "text").agg(F.sum("count").alias("count"))


@query
def modifier_chain_(spark, sf_dir):
    words = ng.from_arrays(cp.document_tokens(spark, sf_dir), 1, {"word": cp.COLUMNS[0]}, []).distinct()
    w = F.col("word")
    chains = {
        "lowered": "toLower",
        "first": "firstChar",
        "first_lowered": "toLower:firstChar",
        "cs_2020": "cs_cnc2020",
        "cs_2000": "cs_cnc2000",
        "cs_spk": "identity:cs_cnc2000_spk",
        "same": "",
    }
    return words.select(
        "word",
        *[modifier_chain(c)(w).alias(n) for n, c in chains.items()],
        modifier_chain("penn")(cp.tag(w)).alias("word_class"),
        modifier_chain("penn:toLower")(cp.tag(w)).alias("word_class_lowered"),
    )


@query
def long_ngram_null(spark, sf_dir):
    spec, rules = _rules(VertColumn(0, "toLower", "lemma"), size=18)
    occurrences = ng.from_arrays(cp.conversation_tokens(spark, sf_dir), 18, rules)
    return ng.frequency_table(ng.count_ngrams(occurrences, ["corpus_id", "col0"]), spec)


@query
def distinct_values_sorted(spark, sf_dir):
    words = ng.from_arrays(cp.document_tokens(spark, sf_dir), 1, {"tag": cp.tag})
    return ng.distinct_values(words, "tag")


@query
def corpus_stats(spark, sf_dir):
    # Counted by word first, so the distinct counts see each word of a corpus once.
    words = ng.count_ngrams(
        ng.from_arrays(cp.document_tokens(spark, sf_dir), 1, {"word": cp.COLUMNS[0]}), ["corpus_id", "word"]
    )
    w = F.col("word")
    return words.groupBy("corpus_id").agg(
        F.sum("count").alias("tokens"),
        F.countDistinct(cp.lemma(w)).alias("lemmas"),
        F.countDistinct(cp.tag(w)).alias("tags"),
    )


# --- vertical lines and structures ------------------------------------------------------------


@query
def vertical_lines_parse(spark, sf_dir):
    lines = cp.document_lines(spark, sf_dir, cp.simple_paragraph, token=cp.full_token)
    names = ["word", "lemma", "tag", "feats"]
    # Lines are counted before they are parsed, so equal ones are parsed once. As the column needs the count, no test of a line is
    # moved to where lines are made, where each mention of the line would make it again.
    counted = lines.groupBy("corpus_id", "line").agg(F.count("*").alias("n"))
    counted = counted.withColumn("line", F.when(F.col("n") > 0, F.col("line")))
    cols = token_lines(counted).select("corpus_id", *[token_column(i).alias(n) for i, n in enumerate(names)], "n")
    return cols.groupBy("corpus_id", *names).agg(F.sum("n").alias("n"))


_DOC_P = StructureSpec({"doc": ["id", "lang", "source", "date"], "p": ["num", "style"]}, atom="p")


def _document_units(spark, sf_dir):
    lines = cp.document_lines(spark, sf_dir, cp.simple_paragraph)
    keep = Stages(spark).keep
    events = keep(st.events_with_token_counts(lines, cp.LINE_ORDER, keep))
    resolved = st.resolve(events, _DOC_P, cp.LINE_ORDER, keep)
    return st.unit_rows(st.mark_units(resolved, _DOC_P, None, cp.LINE_ORDER), _DOC_P, None, cp.LINE_ORDER)


@query
def liveattrs_atoms(spark, sf_dir):
    return _document_units(spark, sf_dir)


@query
def bibliography(spark, sf_dir):
    """Tokens don't matter here, so none is counted."""
    lines = cp.document_lines(spark, sf_dir, cp.simple_paragraph)
    keep = Stages(spark).keep
    events = keep(struct_events(lines).withColumn("tok", F.lit(0)))
    resolved = st.resolve(events, _DOC_P, cp.LINE_ORDER, keep)
    made = st.unit_rows(st.mark_units(resolved, _DOC_P, None, cp.LINE_ORDER), _DOC_P, None, cp.LINE_ORDER)
    return units.bibliography(made, ["doc_id", "doc_source", "doc_date"], "doc_id")


def _conversation_units(spark, sf_dir, spec, join=None, corpus=None):
    lines = cp.conversation_lines(spark, sf_dir)
    keep = Stages(spark).keep
    events = keep(tk.accepted_before_tags(token_lines(lines), struct_events(lines), cp.TURN_ORDER))
    resolved = st.resolve(events, spec, cp.TURN_ORDER, keep)
    marked = st.mark_units(resolved, spec, join, cp.TURN_ORDER)
    return st.unit_rows(marked, spec, join, cp.TURN_ORDER)


_CONV_TURN = StructureSpec({"conv": ["id", "kind"], "turn": ["num", "role"]}, atom="turn", parent="conv")


@query
def liveattrs_parent_rows(spark, sf_dir):
    return _conversation_units(spark, sf_dir, _CONV_TURN)


_DOC_DIV_P = StructureSpec(
    {"doc": ["id"], "div": ["kind", "part"], "p": ["num"]}, atom="p", parent="div", nested=True
)


def _nested_events(spark, sf_dir, paragraph, keep):
    """Two divisions inside each other around the paragraphs of a document."""
    before = (
        F.concat(F.lit('<div kind="'), F.col("lang"), F.lit('">')),
        F.concat(F.lit('<div kind="'), F.col("source"), F.lit('" part="1">')),
    )
    lines = cp.document_lines(spark, sf_dir, paragraph, before, ("</div>", "</div>"))
    return keep(st.events_with_token_counts(lines, cp.LINE_ORDER, keep))


def _nested_units(spark, sf_dir, paragraph):
    keep = Stages(spark).keep
    events = _nested_events(spark, sf_dir, paragraph, keep)
    resolved = st.resolve(events, _DOC_DIV_P, cp.LINE_ORDER, keep)
    marked = st.mark_units(resolved, _DOC_DIV_P, None, cp.LINE_ORDER)
    return st.unit_rows(marked, _DOC_DIV_P, None, cp.LINE_ORDER)


@query
def liveattrs_nested(spark, sf_dir):
    """The outer division's ``kind`` counts, ``part`` is on the inner one."""
    return _nested_units(spark, sf_dir, cp.simple_paragraph)


def _misclosed_paragraph(text, num):
    """In paragraphs with a digit a division is closed that is not the innermost element."""
    wrong = cp.tags_if(text.rlike("[0-9]"), F.lit("</div>"))
    return F.concat(cp.tags(cp.p_tag(num)), cp.paragraph_words(text), wrong, cp.tags(F.lit("</p>")))


@query
def liveattrs_nested_errors(spark, sf_dir):
    """The same units in spite of errors."""
    return _nested_units(spark, sf_dir, _misclosed_paragraph)


@query
def nested_structure_errors(spark, sf_dir):
    keep = Stages(spark).keep
    events = _nested_events(spark, sf_dir, _misclosed_paragraph, keep)
    errors = st.structure_errors(events, _DOC_DIV_P, cp.LINE_ORDER, keep)
    return errors.select("corpus_id", F.col("pos.doc_id").alias("doc_id"), F.col("pos.seq").alias("line"), "message")


_DOC_OPEN = StructureSpec({"doc": ["id"], "p": ["num"]}, "p", nested=True)


@query
def nested_far_errors(spark, sf_dir):
    """Every second document is left open, and every other one closed twice: the second close fits an earlier document, if one is open."""
    keep = Stages(spark).keep
    lines = cp.document_lines(spark, sf_dir, cp.simple_paragraph)
    # The last line of a document, not at all or twice.
    times = F.when(F.col("line") != "</doc>", 1).when(F.col("pos.doc_id") % 2 != 0, 0).otherwise(2)
    rows = lines.select("*", F.posexplode(F.array_repeat(F.lit(True), times)).alias("again", "__x"))
    seq = F.col("seq") + F.col("again")
    rows = rows.withColumns({"seq": seq, "pos": F.struct(F.col("pos.doc_id").alias("doc_id"), seq.alias("seq"))}).drop("again", "__x")
    errors = st.structure_errors(keep(st.events_with_token_counts(rows, cp.LINE_ORDER, keep)), _DOC_OPEN, cp.LINE_ORDER, keep)
    return errors.select("corpus_id", F.col("pos.doc_id").alias("doc_id"), "message")


@query
def error_budgets(spark, sf_dir):
    """Whether a job over the same lines ends early: with a budget of all their errors, and with one error less."""
    keep = Stages(spark).keep
    events = _nested_events(spark, sf_dir, _misclosed_paragraph, keep)
    errors = st.structure_errors(events, _DOC_DIV_P, cp.LINE_ORDER, keep).count()
    rows = []
    for most in (errors, errors - 1):
        budget, stopped = st.Budget(keep, most), False
        try:
            st.resolve(events, _DOC_DIV_P, cp.LINE_ORDER, budget)
        except TooManyErrors:
            stopped = True
        rows.append((most, budget.found, stopped))
    return spark.createDataFrame(rows, "budget long, errors long, stopped boolean")


@query
def structure_errors(spark, sf_dir):
    """Paragraphs without a final stop are left open, those with a digit close a ``q`` never opened.

    Words with a digit have one column too many.
    """

    def token(word):
        return F.when(word.rlike("[0-9]"), F.concat_ws("\t", cp.plain_token(word), F.lit("x"))).otherwise(cp.plain_token(word))

    def paragraph(text, num):
        quote = cp.tags_if(text.rlike("[0-9]"), F.lit("</q>"))
        return F.concat(cp.tags(cp.p_tag(num)), cp.paragraph_words(text), quote, cp.tags_if(text.endswith("."), F.lit("</p>")))

    lines = cp.document_lines(spark, sf_dir, paragraph, token=token)
    keep = Stages(spark).keep
    tags = st.structure_errors(keep(struct_events(lines)), _DOC_P, cp.LINE_ORDER, keep)
    errors = st.all_errors(tags, st.width_errors(token_lines(lines), cp.LINE_ORDER))
    return errors.select("corpus_id", F.col("pos.doc_id").alias("doc_id"), F.col("pos.seq").alias("line"), "message")


def _loose_paragraph(text, num):
    """Only paragraphs that end in a stop are structures; tokens of the others lie between them."""
    words = cp.paragraph_words(text)
    return F.when(text.endswith("."), F.concat(cp.tags(cp.p_tag(num)), words, cp.tags(F.lit("</p>")))).otherwise(words)


def _stored_index(keep, indexed):
    """Stored, tokens take a fraction of what they take in the shuffle for their order, which then goes before that for n-grams is made."""
    return keep(indexed.select("corpus_id", "tok_idx", "segment", "col0"), compression="zstd")


@query
def segment_ngrams(spark, sf_dir):
    lines = cp.document_lines(spark, sf_dir, _loose_paragraph)
    keep = Stages(spark).keep
    events = keep(struct_events(lines).withColumn("tok", F.lit(0)))
    resolved = st.resolve(events, _DOC_P, cp.LINE_ORDER, keep)
    ends = st.unit_ends(resolved, _DOC_P)
    tokens = token_lines(lines).select(*cp.LINE_ORDER.place, token_column(0).alias("col0"))
    indexed = _stored_index(keep, tk.indexed_tokens(tokens, ends, cp.LINE_ORDER))
    return ng.count_ngrams(ng.from_rows(indexed, 2, {"col0": F.col("col0")}), ["corpus_id", "col0"])


@query
def subcorpus_filter(spark, sf_dir):
    """Trigrams of the tokens without digits, in documents of all but two sources."""
    lines = cp.document_lines(spark, sf_dir, cp.simple_paragraph)
    keep = Stages(spark).keep
    events = keep(struct_events(lines).withColumn("tok", F.lit(0)))
    resolved = st.resolve(events, _DOC_P, cp.LINE_ORDER, keep)
    ends = st.unit_ends(resolved, _DOC_P)
    words = token_lines(lines).select(
        *cp.LINE_ORDER.place, token_column(0).alias("word"), token_column(1).alias("col0")
    )
    context = tk.tokens_in_context(words, resolved, ["doc_source"], cp.LINE_ORDER)
    accepted = context.where(~F.col("doc_source").isin("src0", "src1") & ~F.col("word").rlike("[0-9]"))
    accepted = keep(accepted.drop("word", "doc_source"), compression="zstd")
    indexed = _stored_index(keep, tk.indexed_tokens(accepted, ends, cp.LINE_ORDER))
    return ng.count_ngrams(ng.from_rows(indexed, 3, {"col0": F.col("col0")}), ["corpus_id", "col0"])


@query
def liveattrs_selfclosing(spark, sf_dir):
    """Paragraphs without a final stop are self-closing tags; a ``q`` reaches from each odd paragraph into the next."""

    def paragraph(text, num):
        k = (num + 1).cast("string")
        words = cp.paragraph_words(text)
        quote = F.when(num % 2 == 0, F.concat(F.lit('<q part="'), k, F.lit('">'))).otherwise("</q>")
        return F.when(text.endswith("."), F.concat(cp.tags(cp.p_tag(num), quote), words, cp.tags(F.lit("</p>")))).otherwise(
            F.concat(cp.tags(F.concat(F.lit('<p num="'), k, F.lit('"/>')), quote), words)
        )

    last = F.when(F.size(F.split("text", "\n")) % 2 == 1, "</q>").otherwise("")
    lines = cp.document_lines(spark, sf_dir, paragraph, after=(last,))
    spec = StructureSpec({"doc": ["id"], "q": ["part"], "p": ["num"]}, atom="p")
    keep = Stages(spark).keep
    events = keep(st.events_with_token_counts(lines, cp.LINE_ORDER, keep))
    resolved = st.resolve(events, spec, cp.LINE_ORDER, keep)
    return st.unit_rows(st.mark_units(resolved, spec, None, cp.LINE_ORDER), spec, None, cp.LINE_ORDER)


# --- files and stored tables ------------------------------------------------------------------


def _written_vertical(spark, sf_dir, stages, where, latin=False, **options):
    """Documents as vertical files, whose lines follow each other as they are made; ``latin`` in a single-byte charset."""
    lines = cp.document_lines(spark, sf_dir, cp.simple_paragraph, token=cp.full_token, where=where).select("line")
    if latin:
        lines = lines.select(F.encode("line", "ISO-8859-1").cast("string").alias("line"))
    folder = stages.folder()
    lines.write.options(**options).text(folder)
    return folder


def _all_corpora(spark, sf_dir):
    # One row per corpus of the table.
    return [r[0] for r in cp.documents(spark, sf_dir).select("corpus_id").distinct().orderBy("corpus_id").collect()]


@query
def vertical_files_scan(spark, sf_dir):
    """The lines of ``vertical_lines_parse`` from files: plain, packed by gzip, and, where all characters allow it, in a single-byte charset."""
    stages, docs = Stages(spark), cp.documents(spark, sf_dir)
    wide = F.concat_ws("", "text", "source", "lang").rlike("[^\\x00-\\xFF]")
    # One row per corpus of the table.
    found = docs.groupBy("corpus_id").agg(F.count_if(wide).alias("wide")).orderBy(F.desc("wide"), "corpus_id").collect()
    lines = []
    for k, (corpus, beyond) in enumerate(found):
        latin, packed = k > 1 and not beyond, {"compression": "gzip"} if k == 1 else {}
        folder = _written_vertical(spark, sf_dir, stages, F.col("corpus_id") == corpus, latin, **packed)
        paths = resolve_paths(spark, file=folder, skip_hidden=True)
        lines.append(read_lines(spark, paths, corpus, "iso8859-1" if latin else "utf-8"))
    names = ["word", "lemma", "tag", "feats"]
    tokens = token_lines(reduce(DataFrame.union, lines) if lines else cp.document_lines(spark, sf_dir, cp.simple_paragraph, token=cp.full_token))
    cols = tokens.select("corpus_id", *[token_column(i).alias(n) for i, n in enumerate(names)])
    return cols.groupBy("corpus_id", *names).agg(F.count("*").alias("n"))


@query
def vertical_charsets_scan(spark, sf_dir):
    """The lines of ``vertical_lines_parse`` from files in UTF-16 of either byte order and GB18030, each corpus in one of them."""
    stages, names = Stages(spark), ["word", "lemma", "tag", "feats"]
    # The bytes of a line end, as the text that Spark writes for them.
    written = [("UTF-16LE", "utf-16-le", "\n\0"), ("UTF-16BE", "utf-16-be", "\0\n"), ("GB18030", "gb18030", "\n")]
    lines = []
    for corpus, (java, encoding, line_end) in zip(_all_corpora(spark, sf_dir), cycle(written)):
        found = cp.document_lines(spark, sf_dir, cp.simple_paragraph, token=cp.full_token, where=F.col("corpus_id") == corpus)
        with any_charset(spark):
            found = found.select(F.encode("line", java).cast("string").alias("line"))
        folder = stages.folder()
        # Two bytes a character take several times the table; a file is made by one task, and read by one.
        found.write.options(lineSep=line_end, compression="gzip").text(folder)
        lines.append(read_lines(spark, resolve_paths(spark, file=folder, skip_hidden=True), corpus, encoding))
    tokens = token_lines(reduce(DataFrame.union, lines) if lines else cp.document_lines(spark, sf_dir, cp.simple_paragraph, token=cp.full_token))
    cols = tokens.select("corpus_id", *[token_column(i).alias(n) for i, n in enumerate(names)])
    return cols.groupBy("corpus_id", *names).agg(F.count("*").alias("n"))


_STORED_UNITS = ["doc_id", "doc_date", "poscount", "wordcount", "corpus_id"]


def _stored_corpora(spark, sf_dir, stages, root):
    """(target, files, options) of each corpus: the first to be created, the others appended, the last in a moving window."""
    corpora = _all_corpora(spark, sf_dir)
    for k, corpus in enumerate(corpora):
        folder = _written_vertical(spark, sf_dir, stages, F.col("corpus_id") == corpus)
        window = {"date_attr": "doc_date", "remove_before": "2020-06-01"} if 0 < k == len(corpora) - 1 else {}
        files = resolve_paths(spark, file=folder, skip_hidden=True)
        yield sink.Target(root, corpus, group="both"), files, {"append": k > 0, **window}


@query
def sink_units(spark, sf_dir):
    """Text units of every corpus in one table: the first created, the others appended, the last in a moving window."""
    stages, target = Stages(spark), None
    root, spec = stages.folder(), StructureSpec({"doc": ["id", "date"]}, atom="doc")
    for target, files, options in _stored_corpora(spark, sf_dir, stages, root):
        extract(spark, target, spec, files=files, **options)
    return sink.read(spark, target, target.units).select(*_STORED_UNITS)


@query
def sink_frequencies(spark, sf_dir):
    """N-gram counts of every corpus in one table, corpus after corpus."""
    root = Stages(spark).folder()
    spec, rules = _rules(VertColumn(0, ""))
    for k, corpus in enumerate(_all_corpora(spark, sf_dir)):
        target = sink.Target(root, corpus, group="both")
        texts = cp.document_tokens(spark, sf_dir).where(F.col("corpus_id") == corpus)
        counts = ng.count_ngrams(ng.from_arrays(texts, 1, rules), ["corpus_id", "col0"])
        sink.write_frequencies(ng.frequency_table(counts, spec), target, append=k > 0)
    return sink.read(spark, target, target.frequencies)


@query
def sink_units_all(spark, sf_dir):
    """``sink_units`` with appends that must change nothing: each input again (refused), one that fails, and one that replaces its corpus."""
    stages, target = Stages(spark), None
    root, spec = stages.folder(), StructureSpec({"doc": ["id", "date"]}, atom="doc")
    for target, files, options in _stored_corpora(spark, sf_dir, stages, root):
        if "date_attr" in options:
            with contextlib.suppress(TooManyErrors):
                extract(spark, target, spec, files=[*files, _broken(spark, stages)], **options)
                raise AssertionError("an input beyond the budget was stored")
        extract(spark, target, spec, files=files, **options)
        with contextlib.suppress(sink.Repeated):
            extract(spark, target, spec, append=True, files=files)
            raise AssertionError("the same input was stored twice")
    extract(spark, target, spec, append=True, files=files, repeat="replace")
    return sink.read(spark, target, target.units).select(*_STORED_UNITS)


def _broken(spark, stages):
    """A file with an end that has no beginning."""
    folder = stages.folder()
    spark.createDataFrame([("</doc>",)], "line string").coalesce(1).write.text(folder)
    return resolve_paths(spark, file=folder, skip_hidden=True)[0]


@query
def sink_frequencies_all(spark, sf_dir):
    """``sink_frequencies`` with two appends for each corpus, whose counts are added up."""
    root = Stages(spark).folder()
    spec, rules = _rules(VertColumn(0, ""))
    first = True
    for corpus in _all_corpora(spark, sf_dir):
        target = sink.Target(root, corpus, group="both")
        texts = cp.document_tokens(spark, sf_dir).where(F.col("corpus_id") == corpus)
        early = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
        for batch in (early, ~early):  # together the whole corpus
            counts = ng.count_ngrams(ng.from_arrays(texts.where(batch), 1, rules), ["corpus_id", "col0"])
            sink.write_frequencies(ng.frequency_table(counts, spec), target, append=not first)
            first = False
    return sink.read(spark, target, target.frequencies)


@query
def sink_livetokens(spark, sf_dir):
    target = sink.Target(Stages(spark).folder(), "documents")
    sink.write_livetokens(*_stored_livetokens(spark, sf_dir), target)
    found = search.search_tokens(sink.read(spark, target, target.tokens), sink.read(spark, target, target.feats))
    return found.select(*_ATTRS, "cnt", "udfeats")


# --- item ids, alignment, windows -------------------------------------------------------------


def _turns(spark, sf_dir):
    return cp.conversations(spark, sf_dir).select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn_num"), "role"
    )


@query
def item_id_identity(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    made = item_id("identity", [F.col("conv_id"), F.col("turn_num"), F.nullif("role", F.lit("system"))])
    return turns.select("conv_id", "turn_num", "role", made.alias("item_id"))


@query
def item_id_intercorp(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    return turns.select("conv_id", "turn_num", item_id("intercorp", [F.concat("role", "conv_id")]).alias("item_id"))


@query
def item_id_empty(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    made = F.nullif(item_id("empty", [F.col("role")]), F.lit(""))
    return turns.select("conv_id", "turn_num", made.alias("item_id"))


@query
def aligned_join(spark, sf_dir):
    """Roles as corpora, aligned on conversation and exchange (two turns)."""
    rows = cp.conversations(spark, sf_dir).select(
        F.col("role").alias("corpus_id"),
        F.col("turn").alias("turn_num"),
        item_id(
            "identity", [F.col("conv_id").cast("string"), F.shiftright("turn", 1).cast("string")]
        ).alias("item_id"),
        F.size(cp.words_of(F.col("text"))).alias("poscount"),
    )
    return units.aligned(rows, ["turn_num", "poscount"])


@query
def moving_window(spark, sf_dir):
    """French documents have no valid date, so they stay."""
    docs = cp.documents(spark, sf_dir)
    dated = docs.select(
        "corpus_id",
        F.col("doc_id"),
        F.when(F.col("lang") == "fr", F.col("source")).otherwise(cp.day(F.col("doc_id"))).alias("doc_date"),
    )
    return units.moving_window(dated, "doc_date", "2020-03-15")


# --- token attributes and features ------------------------------------------------------------

_ATTRS = ["lemma", "tag"]


def _annotated(spark, sf_dir):
    rules = {"lemma": cp.COLUMNS[1], "tag": cp.COLUMNS[2], "feats": cp.COLUMNS[3]}
    return ng.count_from_arrays(cp.document_tokens(spark, sf_dir), 1, rules, [])


def _combinations(spark, sf_dir):
    return lt.count_combinations(_annotated(spark, sf_dir), _ATTRS, "feats", times="count")


def _livetokens(spark, sf_dir):
    valid = lt.valid_only(_combinations(spark, sf_dir), _ATTRS)
    return lt.token_tables(valid, _ATTRS)


# Folders of this session's stored imports; searches share one, as those of a user would.
_IMPORTED: dict[tuple[str, str, str], str] = {}


def _imported(spark, sf_dir, name, make):
    """``make(keep)``, stored once for the files that documents consist of now; again if it was removed."""
    paths = resolve_paths(spark, f"{sf_dir}/documents.parquet", skip_hidden=True)
    key = (spark.sparkContext.applicationId, sink.input_key(spark, paths), name)
    if key not in _IMPORTED or not sink.exists(spark, f"{_IMPORTED[key]}/_SUCCESS"):
        stages = Stages(spark)
        folder = stages.folder()
        make(stages.keep).write.parquet(folder)
        _IMPORTED[key] = folder
    return spark.read.parquet(_IMPORTED[key])


def _valid_combinations(spark, sf_dir):
    return _imported(spark, sf_dir, "valid", lambda keep: lt.valid_only(_combinations(spark, sf_dir), _ATTRS))


def _stored_livetokens(spark, sf_dir):
    """The two tables as an import leaves them, so that a search reads them instead of the corpus."""
    return lt.token_tables(_valid_combinations(spark, sf_dir), _ATTRS)


def _search_index(spark, sf_dir):
    """The index over the same combinations, as an import leaves it."""
    entries = _imported(spark, sf_dir, "entries", lambda keep: entries_of(_valid_combinations(spark, sf_dir), _ATTRS, keep))
    return SearchIndex(entries, _imported(spark, sf_dir, "bitmaps", lambda keep: sorted_bitmaps(bitmaps_of(entries, _ATTRS))))


@query
def ud_feats_parse(spark, sf_dir):
    raw = ng.from_arrays(cp.document_tokens(spark, sf_dir), 1, {"raw": cp.feats}, []).distinct()
    return raw.select("raw", F.posexplode_outer(feat_sets(F.col("raw"))).alias("block", "feats")).select(
        "raw", F.coalesce("block", F.lit(-1)).alias("block"), feats_key(F.col("feats")).alias("feats_key")
    )


@query
def livetokens_counts(spark, sf_dir):
    return _combinations(spark, sf_dir).select(*_ATTRS, "feats_key", "cnt")


@query
def livetokens_valid(spark, sf_dir):
    return _combinations(spark, sf_dir).select(
        *_ATTRS,
        "feats_key",
        "cnt",
        lt.looks_valid(_ATTRS).alias("valid"),
        lt.looks_valid(_ATTRS, strict_numeric=True).alias("valid_strict"),
    )


@query
def livetokens_feats(spark, sf_dir):
    tokens, feats = _livetokens(spark, sf_dir)
    return feats.select("token_id", "feat", "value")


@query
def search_tokens(spark, sf_dir):
    found = _search_index(spark, sf_dir).search({"tag": "NNS"}, {"Cap": "No", "Len": ["M", "L"]})
    return found.select(*_ATTRS, "cnt", F.col("feats_key").alias("udfeats"))


@query
def search_total(spark, sf_dir):
    return _search_index(spark, sf_dir).total({"tag": ["NNP", "VBG"]}, [("Len", "L")])


@query
def facet_attr_values(spark, sf_dir):
    found = _search_index(spark, sf_dir).facets(_ATTRS, {"tag": ["NNS", "VBG"]}, {"Len": ["M", "L"], "Cap": "No"}, feats=False)
    return found.select("name", "value").orderBy("name", "value")


@query
def facet_feat_values(spark, sf_dir):
    found = _search_index(spark, sf_dir).facets([], {"tag": ["NNS", "NNP"]}, {"Cap": ["Yes", "No"]})
    return found.select(F.col("name").alias("feat"), "value").orderBy("feat", "value")


@query
def facet_counts(spark, sf_dir):
    """Values of attributes and features under a filter, with the number of combinations that have them."""
    return _search_index(spark, sf_dir).facets(_ATTRS, {"tag": ["NNS", "VBG"]}, {"Len": ["M", "L"]})


@query
def search_token_tables(spark, sf_dir):
    """A search that joins the two tables and needs no index."""
    tokens, feats = _stored_livetokens(spark, sf_dir)
    found = search.search_tokens(tokens, feats, {"tag": ["NNP", "VBG"]}, [("Len", "L")])
    return found.select(*_ATTRS, "cnt", "udfeats")


@query
def token_ids(spark, sf_dir):
    """Combinations numbered in the order of their attributes and features."""
    return _search_index(spark, sf_dir).entries.select("id", *_ATTRS, "feats_key", "cnt")


@query
def sink_search_index(spark, sf_dir):
    """Tables with an index stored as one snapshot, and a search of what is stored."""
    target = sink.Target(Stages(spark).folder(), "documents")
    entries = entries_of(_valid_combinations(spark, sf_dir), _ATTRS, Stages(spark).keep)
    sink.write_livetokens(*_stored_livetokens(spark, sf_dir), target, None, entries, _ATTRS)
    return sink.read_index(spark, target).search().select(*_ATTRS, "cnt", F.col("feats_key").alias("udfeats"))


@query
def search_feats_map(spark, sf_dir):
    tokens, feats = _stored_livetokens(spark, sf_dir)
    found = search.search_tokens(tokens, feats, None, {"Cap": "Yes"}).withColumn("map", search.feats_map(F.col("feats")))
    pairs = F.array_sort(F.transform(F.map_entries("map"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return found.select("lemma", "cnt", F.array_join(pairs, "|").alias("feats"), F.col("map")["Suf"].alias("suffix"))


@query
def available_values(spark, sf_dir):
    tokens, feats = _stored_livetokens(spark, sf_dir)
    keep = Stages(spark).keep
    return search.available_values(tokens, feats, _ATTRS, {"tag": ["NNS", "VBG"]}, {"Len": ["M", "L"]}, keep=keep)
