"""Which profile a paper belongs to, and which of its chunks to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.profiles import ALIASES, KEYWORDS, SCIENCE, Profiles
from evidentia.functions.text import LABEL_SEPARATORS, collapse, fold, let, normalize, occurrences
from evidentia.operators.chunks import unnest


def _texts(values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _signal(s: str) -> str:
    """A signal as it reads in normalised text."""
    return " ".join("".join(" " if c in "_-/;,|:()[]{}" else c for c in s.casefold()).split())


def matches(text: Column, signals: tuple[str, ...]) -> Column:
    """The signals that occur anywhere in normalised ``text``, in their order."""
    pairs = F.array(*(F.struct(F.lit(s).alias("signal"), F.lit(_signal(s)).alias("as_read")) for s in signals))
    return F.transform(F.filter(pairs, lambda p: F.contains(text, p["as_read"])), lambda p: p["signal"])


def _first_best(scores: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """Name and score of the best; of equals, the first."""
    top = F.greatest(*(s for _, s in scores)) if len(scores) > 1 else scores[0][1]
    name = F.lit(scores[-1][0])
    for n, s in reversed(scores[:-1]):
        name = F.when(s == top, n).otherwise(name)
    return name, top


def classify(papers: DataFrame, p: Profiles = SCIENCE) -> DataFrame:
    """``papers`` with classification: domain, mode, scores and matched signals.

    Scores count distinct signals in the whole paper.  The best specialist wins unless it
    has none or the general domain has over twice as many.  The best mode wins unless
    signals of contrast, then of intervention, force one; in the general domain the
    fallback mode wins a draw.
    """
    whole = normalize(F.array_join(F.transform("chunks", lambda c: c["text"]), "\n"))
    names = {f"domain_{d}": s for d, s in p.domains.items()} | {f"mode_{m}": s for m, s in p.modes.items()}
    found = let(whole, lambda t: F.struct(*(matches(t, s).alias(n) for n, s in names.items())))
    d = papers.withColumn("found", found)
    size = lambda n: F.size(F.col(f"found.{n}"))
    specialist, most = _first_best([(x, size(f"domain_{x}")) for x in p.domains if x != p.general])
    general = size(f"domain_{p.general}")
    d = d.withColumn("domain", F.when((most == 0) | (general > 2 * most), p.general).otherwise(specialist))
    mode, top = _first_best([(m, size(f"mode_{m}")) for m in p.modes])
    best = F.when(top == 0, p.fallback_mode).otherwise(mode)
    score = F.when(top == 0, size(f"mode_{p.fallback_mode}")).otherwise(top)
    forced = lambda rule: F.arrays_overlap(F.col(f"found.mode_{rule[0]}"), _texts(rule[1]))
    fallback = (F.col("domain") == p.general) & (size(f"mode_{p.fallback_mode}") >= score)
    mode = F.when(forced(p.contrast), p.contrast[0]).when(forced(p.intervention), p.intervention[0]).when(fallback, p.fallback_mode).otherwise(best)
    reason = F.when(forced(p.contrast), "signals of contrast").when(forced(p.intervention), "signals of intervention").when(fallback, "fallback in the general domain").otherwise("most signals")
    d = d.withColumns({"mode": mode, "mode_reason": reason})
    of = lambda kind, among: F.map_from_arrays(_texts(tuple(among)), F.array(*(size(f"{kind}_{x}") for x in among)))
    chosen = lambda kind, among, key: F.coalesce(*(F.when(F.col(key) == x, F.col(f"found.{kind}_{x}")) for x in among))
    d = d.withColumn(
        "classification",
        F.struct(
            "domain", "mode", "mode_reason", of("domain", p.domains).alias("domain_scores"), of("mode", p.modes).alias("mode_scores"),
            chosen("domain", p.domains, "domain").alias("domain_signals"), chosen("mode", p.modes, "mode").alias("mode_signals"),
        ),
    )
    return d.drop("found", "domain", "mode", "mode_reason")


def _weighted(text: Column, signals: Column) -> Column:
    return F.aggregate(signals, F.lit(0), lambda a, s: a + F.least(occurrences(text, s), F.lit(3)))


def scored(papers: DataFrame, p: Profiles = SCIENCE) -> DataFrame:
    """Classified ``papers`` with a score for each chunk: twice the domain's signals, four times the mode's, and generic ones, each up to 3 times.

    A chunk that begins with references has -1000.
    """
    read = lambda values: _texts(tuple(map(_signal, values)))
    pick = lambda key, among: F.coalesce(*(F.when(F.col(key) == x, read(s)) for x, s in among.items()))
    signals = F.struct(pick("classification.domain", p.domains).alias("domain"), pick("classification.mode", p.modes).alias("mode"))

    def score(text: Column, s: Column) -> Column:
        of = lambda t: F.when(F.startswith(t, F.lit("references ")), -1000).otherwise(2 * _weighted(t, s["domain"]) + 4 * _weighted(t, s["mode"]) + _weighted(t, read(p.generic)))
        return let(normalize(text), of)

    # bound once a paper: a column named inside the lambda would be worked out for every chunk
    return papers.withColumn("scores", let(signals, lambda s: F.transform("chunks", lambda c: score(c["text"], s))))


def select(papers: DataFrame, max_chunks: int = 4, ordinals: tuple[int, ...] | None = None) -> DataFrame:
    """Scored ``papers`` with selected: the first chunk and the best others, in order.

    Given ``ordinals`` are taken instead, in the order given, each once; an unknown one
    leaves the paper's selection null with its ``unknown`` ordinals.
    """
    if max_chunks < 1:
        raise ValueError("max_chunks must be at least 1")
    if ordinals is not None:
        if not ordinals:
            raise ValueError("ordinals must not be empty")
        wanted = F.array(*map(F.lit, dict.fromkeys(ordinals)))
        unknown = F.array_except(wanted, F.transform("chunks", lambda c: c["ordinal"]))
        return papers.withColumns({"unknown": unknown, "selected": F.when(F.size(unknown) == 0, wanted)})
    place = F.transform(F.arrays_zip("scores", F.transform("chunks", lambda c: c["ordinal"]).alias("o")), lambda x: F.struct((x["o"] != 1).alias("later"), (-x["scores"]).alias("less"), x["o"].alias("ordinal")))
    best = F.slice(F.array_sort(place), 1, max_chunks)
    return papers.withColumn("selected", F.array_sort(F.transform(best, lambda x: x["ordinal"])))


def plan(papers: DataFrame, p: Profiles = SCIENCE, max_chunks: int = 4) -> DataFrame:
    """Papers classified, scored and selected, in one pass without a shuffle."""
    return select(scored(classify(papers, p), p), max_chunks)


def selected_rows(planned: DataFrame) -> DataFrame:
    """(paper_id, chunk_id, ordinal, score): a row for each selected chunk."""
    each = F.arrays_zip(F.transform("chunks", lambda c: c["chunk_id"]).alias("chunk_id"), F.transform("chunks", lambda c: c["ordinal"]).alias("ordinal"), F.col("scores").alias("score"))
    kept = F.filter(each, lambda x: F.array_contains(F.col("selected"), x["ordinal"]))
    return unnest(planned, kept, "ordinal")


def coverage(planned: DataFrame) -> DataFrame:
    """(paper_id, chunk_id, status): extracted for selected chunks, not_selected for the others."""
    status = lambda c: F.when(F.array_contains(F.col("selected"), c["ordinal"]), "extracted").otherwise("not_selected")
    return unnest(planned, F.transform("chunks", lambda c: F.struct(c["chunk_id"].alias("chunk_id"), status(c).alias("status"))), "chunk_id")


def resolve_plan(plans: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of ``plans`` (paper_id, chunk_ids, ordinals) in order, and what doesn't agree with ``chunks``."""
    asked = plans.select("paper_id", F.posexplode(F.arrays_zip("chunk_ids", "ordinals")).alias("at", "x")).select("paper_id", "at", F.col("x.chunk_ids").alias("chunk_id"), F.col("x.ordinals").alias("planned"))
    found = asked.join(chunks, ["paper_id", "chunk_id"], "left")
    problem = F.when(F.col("ordinal").isNull(), "unknown_chunk").when(F.col("ordinal") != F.col("planned"), "ordinal_differs")
    return found.filter(problem.isNull()), found.withColumn("rule", problem).filter("rule is not null").select("rule", "paper_id", "chunk_id")


def domain_of(label: Column) -> Column:
    """The domain a label names: itself, by alias, by keyword, else the general one."""
    names = [*dict.fromkeys([*(d for d, _ in KEYWORDS), "general_method"])]

    def of(read: Column) -> Column:
        under = F.replace(read, F.lit(" "), F.lit("_"))
        out = F.when(under.isin(names), under)
        for alias, domain in ALIASES.items():
            out = out.when(under == alias, domain)
        for domain, words in KEYWORDS:
            for w in words:
                out = out.when(F.contains(read, F.lit(w)), domain)
        return out.otherwise("general_method")

    read = collapse(F.translate(fold(F.coalesce(label, F.lit(""))), LABEL_SEPARATORS, " " * len(LABEL_SEPARATORS)))
    return let(read, of)


def mode_of(label: Column) -> Column:
    """The mode a label names, else null."""
    read = F.replace(collapse(F.replace(fold(label), F.lit("-"), F.lit(" "))), F.lit(" "), F.lit("_"))
    return F.when(read.isin(list(SCIENCE.modes)), read)
