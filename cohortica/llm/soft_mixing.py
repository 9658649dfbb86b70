"""Mixing of documents to target domain weights under soft membership. DataFrame functions only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import Written

BLANKS = "[ \\t\\n\\x0B\\f\\r]+"
MARKS = "!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"
NONE = "\x00none"


def words(column: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), BLANKS), "")


def domain_of(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, domain) from quality and toxic marks: toxic where toxic is 1, else good or poor by quality. Rows without an
    id or without the mark that decides are left out; of unlike marks of one id the first by name counts."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), domain.alias("domain")).where("id IS NOT NULL AND domain IS NOT NULL")
    return marked.groupBy("id").agg(F.min("domain").alias("domain"))


def marker_words(texts: DataFrame, known: DataFrame, domains: list[str], per_domain: int, top: int) -> dict[str, list[str]]:
    """Of each domain the ``top`` words that its documents hold most beyond the others', from at most ``per_domain``
    labelled documents each (smallest hashes of the id)."""
    ranked = known.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy(F.xxhash64("id"), "id")))
    sample = ranked.where(F.col("rank") <= per_domain).select("id", "domain")
    # At most len(domains) * per_domain ids: the broadcast has that bound.
    held = texts.join(F.broadcast(sample), "id").select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    sizes = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    total = sum(sizes.values())
    counts = held.groupBy("word").agg(*[F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains)], F.count("*").alias("n"))
    scored = []
    for k, d in enumerate(domains):
        size, own = sizes.get(d, 0), F.col(f"n{k}")
        odds = F.log((own + 0.5) / (size + 1)) - F.log((F.col("n") - own + 0.5) / (total - size + 1))
        scored.append(counts.where(own >= 5).select(F.lit(d).alias("domain"), "word", F.round(odds * F.sqrt(own), 9).alias("odds")).where("odds > 0"))
    every = scored[0]
    for s in scored[1:]:
        every = every.union(s)
    best = every.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("odds"), "word"))).where(F.col("rank") <= top)
    out = {d: [] for d in domains}
    for r in best.orderBy("domain", "rank").collect():  # len(domains) * top rows
        out[r["domain"]].append(r["word"])
    return out


def bins(docs: DataFrame, markers: dict[str, list[str]], category_cols: list[str]) -> DataFrame:
    """Tokens and binned features of every whole text: length, distinct words, marks, marker words and categories."""
    split = docs.withColumn("words", words(F.col("text")))
    size, text = F.size("words"), F.coalesce(F.col("text"), F.lit(""))
    length = F.length(text)
    found = [
        F.floor(F.log2(size + 1.0)),
        F.when(size > 0, F.floor(F.size(F.array_distinct("words")) * 8 / size)).otherwise(0),
        F.when(length > 0, F.least(F.floor((length - F.length(F.translate(text, MARKS, ""))) * 40 / length), F.lit(8))).otherwise(0),
    ]
    found += [F.least(F.size(F.array_intersect("words", F.array(*map(F.lit, m)))), F.lit(4)) for m in markers.values() if m]
    found = [f.cast("string") for f in found] + [F.coalesce(F.col(f"category{k}").cast("string"), F.lit(NONE)) for k in range(len(category_cols))]
    return split.select("id", F.xxhash64("text").alias("text_hash"), size.cast("long").alias("tokens"), *[f.alias(f"f{k}") for k, f in enumerate(found)])


def posteriors(binned: DataFrame, known: DataFrame, domains: list[str]) -> DataFrame:
    """(id, text_hash, tokens, p): naive Bayes from tables of counts of each bin by domain over all labelled documents, with
    one added to each count. Bins that no labelled document has count as seen once in every domain."""
    features = [c for c in binned.columns if c[0] == "f" and c[1:].isdigit()]
    labelled = binned.join(known, "id").select("domain", *features)
    sizes = {r["domain"]: r["count"] for r in labelled.groupBy("domain").count().collect()}
    total = sum(sizes.values())
    score = [F.lit(float(np.log((sizes.get(d, 0) + 1) / (total + len(domains))))) for d in domains]
    scored = binned
    for f in features:
        counts = labelled.groupBy(f).agg(*[F.count_if(F.col("domain") == d).alias(f"{f}n{k}") for k, d in enumerate(domains)])
        # Written, so Spark knows its size when it chooses how to join.
        table = Written(counts, "mix-counts").df
        scored = scored.join(table, f, "left")
        score = [
            s + F.log((F.coalesce(F.col(f"{f}n{k}"), F.lit(0)) + 1.0) / (sizes.get(d, 0) + 8.0))
            for k, (s, d) in enumerate(zip(score, domains))
        ]
    logs = F.array(*score)
    shifted = F.transform("logs", lambda x: F.exp(x - F.array_max("logs")))
    shares = F.transform("weights", lambda x: F.round(x / F.aggregate("weights", F.lit(0.0), lambda a, b: a + b), 6))
    return scored.select("id", "text_hash", "tokens", logs.alias("logs")).withColumn("weights", shifted).select("id", "text_hash", "tokens", shares.alias("p"))


def rate(p: Column, low: Column, steps: list[tuple[list[float], float]], ahead: bool = False) -> Column:
    """The rate after accelerated projected steps from 1, or with ``ahead`` the point that the next step starts from.

    Each step takes the product of the posteriors and its direction off the point ahead, never below ``low``, and looks
    on by its momentum."""
    one = F.greatest(low, F.lit(1.0))
    state = F.struct(one.alias("r"), one.alias("y"))
    if steps:
        path = F.array(*[F.struct(F.array(*map(F.lit, d)).alias("d"), F.lit(m).alias("m")) for d, m in steps])

        def move(at, step):
            r = F.greatest(low, at["y"] - F.aggregate(F.zip_with(p, step["d"], lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))
            return F.struct(r.alias("r"), (r + step["m"] * (r - at["r"])).alias("y"))

        state = F.aggregate(path, state, move)
    return state["y" if ahead else "r"]


def fit(cells: DataFrame, wanted: list[float] | None, weights: list[float], rounds: int = 80, tolerance: float = 1e-4):
    """Steps of projected-gradient least squares on cells (p, low, tokens), and the totals reached and wanted.

    Minimises the distance of expected domain totals from the targets, measured by the inverse of the cells' second
    moments; in that metric a step of 1 is safe. Every round sums over all cells in one aggregate; the driver holds one
    number per domain. Ends when all totals are within ``tolerance`` of the targets, relatively, when a step moves them by
    less than a tenth of that (targets that ``low`` puts out of reach), or after ``rounds``."""
    n = len(weights)
    moments = cells.agg(
        *[F.sum(F.col("tokens") * F.col("p")[a] * F.col("p")[b]).alias(f"m{a}_{b}") for a in range(n) for b in range(a, n)],
        F.sum("tokens").alias("all"),
    ).first()
    if not moments["all"]:
        return [], [0.0] * n, [0.0] * n
    square = np.array([[moments[f"m{min(a, b)}_{max(a, b)}"] for b in range(n)] for a in range(n)], float) / moments["all"]
    inverse = np.linalg.inv(square + 1e-9 * np.eye(n))
    target = np.array(wanted if wanted else [w / sum(weights) * moments["all"] for w in weights], float)

    def totals(ahead: bool) -> np.ndarray:
        at = rate(F.col("p"), F.col("low"), steps, ahead)
        sums = cells.withColumn("r", at).agg(*[F.sum(F.col("tokens") * F.col("p")[a] * F.col("r")).alias(f"s{a}") for a in range(n)]).first()
        return np.array([sums[f"s{a}"] for a in range(n)], float)

    steps: list[tuple[list[float], float]] = []
    t, before = 1.0, np.full(n, np.inf)
    while len(steps) < rounds:
        reached = totals(ahead=True)
        if (np.abs(reached - before) <= tolerance / 10 * target).all():
            break
        before = reached
        if (np.abs(reached - target) <= tolerance * target).all() and (np.abs(totals(False) - target) <= tolerance * target).all():
            break
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        direction = inverse @ (reached - target) / moments["all"]
        steps.append(([float(x) for x in direction], float((t - 1) / after)))
        t = after
    return steps, totals(False).tolist(), target.tolist()


def mix(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
    category_cols: tuple = ("source", "lang"), protect: tuple = (), per_domain: int = 2048, top: int = 48, rounds: int = 80,
) -> DataFrame:
    """Rates of documents at which the expected token totals of the domains match ``weights``.

    One row per input row: id, tokens (words), p_<domain> (posterior), rate (>= 0; an expected number of copies),
    copies (the rate rounded down, or up by a hash of the id). Without ``protect`` the total stays that of all tokens; a
    document that most likely belongs to a domain in ``protect`` has a rate of 1 at least, and the total is such that
    the first protected domain keeps its tokens.

    Null and empty texts have no tokens; their rates follow from their posteriors. Null categories are a value of
    their own. Repeated rows are documents of their own; rows of one id round alike. Without labels all posteriors are
    equal. ``text_hash`` tells rows of one id apart."""
    domains = sorted(weights)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
        *[F.col(f"`{c}`").alias(f"category{k}") for k, c in enumerate(category_cols)])
    known = domain_of(labels).where(F.col("domain").isin(domains))
    binned = Written(bins(rows, marker_words(rows, known, domains, per_domain, top), list(category_cols)), "mix-bins")
    judged = Written(posteriors(binned.df, known, domains), "mix-posteriors")
    binned.drop()
    low = F.lit(0.0)
    if protect:
        best = F.array_position("p", F.array_max("p"))
        low = F.when(best.isin([domains.index(d) + 1 for d in protect]), 1.0).otherwise(0.0)
    cells = Written(judged.df.groupBy("p", low.alias("low")).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    share, wanted = [weights[d] / sum(weights.values()) for d in domains], None
    if protect:
        first = domains.index(protect[0])
        held = cells.df.agg(F.sum(F.col("tokens") * F.col("p")[first])).first()[0] or 0.0
        wanted = [held * s / share[first] for s in share] if held else None
    steps, _, _ = fit(cells.df, wanted, share, rounds)
    cells.drop()
    out = judged.df.withColumn("rate", rate(F.col("p"), low, steps))
    draw = F.pmod(F.xxhash64("id", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return out.select(
        F.col("id").alias(id_col), "tokens", *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(domains)],
        "rate", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).alias("copies"), "text_hash")


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], protect: tuple, id_col: str = "doc_id",
          text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as mixing gives it copies, so the rows hold the token shares of ``weights``.
    Documents of protected domains all stay. Rows that agree in id and text have one number of copies."""
    found = mix(docs, labels, weights, id_col, text_col, protect=protect, **options)
    copies = found.groupBy(F.col(id_col).alias("copy_id"), F.col("text_hash").alias("copy_hash")).agg(F.max("copies").alias("copies"))
    same = docs[id_col].eqNullSafe(copies["copy_id"]) & (F.xxhash64(docs[text_col]) == copies["copy_hash"])
    often = docs.join(copies.where("copies > 0"), same).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return often.select(*[docs[c] for c in docs.columns])
