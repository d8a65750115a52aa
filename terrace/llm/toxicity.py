"""Toxicity scores from a weighted finite-state pattern grammar (operator 4).

Tokens map to classes: insult (a learned lexicon of word starts with
weights), threat, target (the person addressed apart from others), negation,
reported speech, or other.  Small machines - target seen, negation in reach,
speech reported, threat pending, addressed in reach - are composed into one
deterministic machine over those classes; reading a clause, it emits each
insult's weight into the channel of the state it is in (plain, aimed at a target,
negated, reported).  A threat that is neither negated nor reported is scored
where it meets its object: a target within ``PENDING`` tokens after it, or the
person addressed shortly before it; a subject ("they beat the record") is
none.  A document's features
are its clauses' channel sums, the strongest clause and the density, and a
logistic model turns them into a score.

Only clauses with an insult or a threat are read token by token; one
pattern (a trie of the lexicon) finds them in the whole text.

Learning uses labelled rows with crc32(key) mod 5 other than 0, at most
``TOXIC_ROWS`` and ``CLEAN_ROWS`` of them (the first by a hash of the key), and
of near copies one (the text of least hash): a copied text's words would else look like evidence.
Word starts are counted on the executors; the driver receives the lexicon
candidates (``CANDIDATES`` at most) and one feature row per sampled text.

Defined cases: null and empty texts score like a text without matches; a
null row key is not held out and never labelled; labels other than 0 and 1
are ignored, of repeated labels the larger counts; without labels of both
kinds ``FALLBACK`` words and weights apply; repeated rows each get a score;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from terrace.llm.common import prepare, stored, table

TOXIC_ROWS, CLEAN_ROWS = 3000, 5000
CANDIDATES = 20_000
LEXICON = 400               # word starts at most
SHORTEST, LONGEST = 3, 14   # characters of a word start
LEAST_EVIDENCE = 30.0       # G2 of a word start occurring in a text
REPEATS = 3                 # or occurring so often in it, with this evidence
REPEATED_EVIDENCE = 19.0
TOP_WEIGHT = 6.0
RIDGE = 1.0

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W\d_]+(?:(?<=n)['\u2019]t\b)?")      # as WORD, with n't kept
CLAUSE_END = re.compile(r"[.!?;\n]")

OTHER, INSULT, THREAT, TARGET, NEGATION, SPEECH, ADDRESSED = range(7)
# Word lists of the fixed classes in the four languages; a token such as "won't" is a negation by its ending.
WORDS = {
    ADDRESSED: "you your yours tu vous toi ton te du dich dir ihr euch tú usted ustedes",
    TARGET: "he him she her they them this these that who il elle ils ce cette er ihn sie ihnen dieser diese "
            "él ella ellos este esta",
    NEGATION: "not never no without neither nor isn aren wasn don doesn ne pas jamais sans nicht kein keine nie ohne "
              "nunca sin tampoco",
    SPEECH: "said says told wrote quoted called dit disait écrit sagte sagt schrieb dijo dice escribió",
}
# Threats: a word start and its inflections, so that no "stable" or "Tuesday" is one.
THREATS = (
    r"kill(?:s|ed|ing|ers?)?", r"hurt(?:s|ing)?", r"destroy(?:s|ed|ing)?", r"burn(?:s|t|ed|ing)?", r"beat(?:s|en|ing)?",
    r"stab(?:s|bed|bing)?", r"shoot(?:s|ing)?", r"shot",
    r"tu(?:er|es?|ée?s?|ez|ons|ant|ai[st]|aient)", r"tuer(?:ai|as|a|ons|ez|ont|ais|ait|aient|ions|iez)",
    r"frapp(?:er?|es|ée?s?|ez|ons|ent|ant|ai[st]|aient)", r"frapper(?:ai|as|a|ons|ez|ont|ais|ait|aient|ions|iez)",
    r"(?:ge)?töte?(?:n|s?t|te[nt]?|test|nd)?", r"(?:er|zer|zu|ge)?schlag(?:en?|t|end)?", r"(?:er|zer)?schläg(?:s?t)", r"(?:er|zer)?schlug(?:en|st|t)?",
    r"mat(?:ar|o|as?|amos|an|é|aste|ó|aron|ando|ad[oa]s?|aba[ns]?|aré|arás?|aremos|arán|aría[ns]?)",
    r"golpe(?:ar|o|as?|amos|an|é|aste|ó|aron|ando|ad[oa]s?|aba[ns]?|aré|arás?|aremos|arán|aría[ns]?)",
)
THREATENING = re.compile("|".join(THREATS))
THREAT_WEIGHT = 3.0
CLASS_OF = {w: c for c, ws in WORDS.items() for w in ws.split()}
FALLBACK = {"idiot": 5.0, "moron": 5.0, "stupid": 4.0, "scum": 5.0, "pathetic": 4.0, "worthless": 4.0, "loser": 4.0}
FALLBACK_MODEL = [-5.0, 0.5, 0.5, 0.2, 0.2, 0.5, 1.0, 1.0]

# ------------------------------------------------------------------- grammar
# A machine: (states, start, step), with step(state, class) -> state.
REACH = 4                   # tokens that a negation or a reporting verb governs
ADDRESS = 6                 # tokens after the person addressed in which a threat is theirs
PENDING = 3                 # tokens after a threat in which its object follows
CLASSES = 7


def target_machine():
    return range(2), 0, lambda s, c: 1 if c in (TARGET, ADDRESSED) else s


def reach_machine(opener: int, reach: int = REACH):
    return range(reach + 1), 0, lambda s, c: reach if c == opener else max(0, s - 1)


def composed(*machines) -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """The product machine: step table [state][class], and each state's parts."""
    parts = list(product(*[m[0] for m in machines]))
    index = {p: i for i, p in enumerate(parts)}
    table_ = [[index[tuple(m[2](s, c) for m, s in zip(machines, p))] for c in range(CLASSES)] for p in parts]
    return table_, parts


PLAIN, AIMED, NEGATED, REPORTED, THREATENED = range(5)
STEP, PARTS = composed(target_machine(), reach_machine(NEGATION), reach_machine(SPEECH),
                       reach_machine(THREAT, PENDING + 1), reach_machine(ADDRESSED, ADDRESS))
START = PARTS.index((0, 0, 0, 0, 0))
CHANNEL = [NEGATED if neg else REPORTED if rep else AIMED if aim else PLAIN for aim, neg, rep, _, _ in PARTS]
IS_PENDING = [p[3] > 0 for p in PARTS]
IS_ADDRESSED = [p[4] > 0 for p in PARTS]


def clause_channels(classes: list[tuple[int, float]]) -> list[float]:
    """Weights that a clause emits into the five channels."""
    out, state, held = [0.0] * 5, START, 0.0
    for c, w in classes:
        state = STEP[state][c]
        if not IS_PENDING[state]:
            held = 0.0                               # its object did not follow
        if c == INSULT:
            out[CHANNEL[state]] += w
        elif c == THREAT and CHANNEL[state] in (PLAIN, AIMED):
            if IS_ADDRESSED[state]:
                out[THREATENED] += w
            else:
                held += w
        elif c in (TARGET, ADDRESSED):
            out[THREATENED] += held
            held = 0.0
    return out


# --------------------------------------------------------------------- model
def trie_pattern(words: list[str]) -> str:
    """One pattern that matches any of ``words``, shared starts written once."""
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def write(node: dict) -> str:
        if "" in node:
            return ""
        arms = [re.escape(ch) + write(child) for ch, child in sorted(node.items())]
        return arms[0] if len(arms) == 1 else f"(?:{'|'.join(arms)})"

    return write(root)


@dataclass
class Grammar:
    """The lexicon of insults (word starts) and the logistic weights."""
    lexicon: dict[str, float]
    model: list[float]

    def __post_init__(self) -> None:
        starts = trie_pattern(sorted(self.lexicon)) if self.lexicon else r"(?!)"
        self.trigger = re.compile(rf"\b(?:{starts}|(?:{THREATENING.pattern})\b)")
        self.start = re.compile(starts)

    def token(self, word: str) -> tuple[int, float]:
        m = self.start.match(word)
        if m:
            return INSULT, self.lexicon[m[0]]
        if THREATENING.fullmatch(word):
            return THREAT, THREAT_WEIGHT
        if word.endswith(("n't", "n\u2019t")):
            return NEGATION, 0.0
        return CLASS_OF.get(word, OTHER), 0.0

    def features(self, text: str) -> list[float]:
        """Channel sums, the strongest clause, density, number of distinct matches (all log scaled)."""
        low, sums, strongest, seen = text.lower(), [0.0] * 5, 0.0, set()
        m = self.trigger.search(low)
        while m:
            begin = max((low.rfind(ch, 0, m.start()) for ch in ".!?;\n")) + 1
            stop = CLAUSE_END.search(low, m.end())
            end = stop.start() if stop else len(low)
            words = TOKEN.findall(low, begin, end)
            seen.update(w for w in words if self.start.match(w))
            channels = clause_channels([self.token(w) for w in words])
            if channels[THREATENED]:
                seen.update(w for w in words if THREATENING.fullmatch(w))
            sums = [a + b for a, b in zip(sums, channels)]
            strongest = max(strongest, sum(channels))
            m = self.trigger.search(low, end)
        n = low.count(" ") + 1
        return [np.log1p(s) for s in sums] + [np.log1p(strongest), np.log1p(100.0 * sum(sums) / n),
                                              np.log1p(len(seen)), np.log1p(n) * (sum(sums) > 0)]

    def score(self, text: str) -> float:
        z = self.model[0] + float(np.dot(self.model[1:], self.features(text)))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> list[float]:
    """Ridge logistic regression by Newton steps on scaled features; bias first."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / spread])
    penalty = ridge * np.eye(a.shape[1])
    penalty[0, 0] = 1e-6
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    beta = w[1:] / spread
    return [float(w[0] - beta @ mean), *map(float, beta)]


def choose_lexicon(counts: list[tuple[str, int, int, int, int]], n1: int, n0: int) -> dict[str, float]:
    """Word starts that set toxic texts apart; none is a start of another.

    ``counts``: toxic and clean texts with the start once, then with it ``REPEATS`` times.
    """
    scored = []
    for start, *seen in counts:
        best = None
        for d1, d0, least in ((*seen[:2], LEAST_EVIDENCE), (*seen[2:], REPEATED_EVIDENCE)):
            share = (d1 + d0) / (n1 + n0)
            g2 = 2 * sum(o * np.log(o / e) for o, e in ((d1, n1 * share), (d0, n0 * share)) if o)
            weight = np.log((d1 + 0.5) / (n1 + 1)) - np.log((d0 + 0.5) / (n0 + 1))
            if g2 >= least and weight > 1.0:
                best = max(best or (0.0, 0.0), (g2, float(min(TOP_WEIGHT, weight))))
        if best:
            scored.append((best[0], len(start), start, best[1]))
    chosen: dict[str, float] = {}
    for _, _, start, weight in sorted(scored, key=lambda s: (-s[0], -s[1], s[2])):
        if len(chosen) == LEXICON:
            break
        if not any(start.startswith(c) or c.startswith(start) for c in chosen):
            chosen[start] = weight
    return chosen


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def family(text: Column) -> Column:
    """Least hash of a text's long words, or of the text: the same for most near copies."""
    low = F.lower(F.coalesce(text, F.lit("")))
    words = F.transform(F.regexp_extract_all(low, F.lit(r"\p{L}{7,}"), F.lit(0)), lambda w: F.xxhash64(w))
    return F.coalesce(F.array_min(words), F.xxhash64(low))


COUNTS = ["d1", "d0", "r1", "r0"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per word start: toxic, clean, and of each those with ``REPEATS`` occurrences."""
    for b in batches:
        once, often = (Counter(), Counter()), (Counter(), Counter())
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            starts: Counter = Counter()
            for w, n in Counter(WORD.findall((text or "").lower())).items():
                for k in range(SHORTEST, min(len(w), LONGEST) + 1):
                    starts[w[:k]] += n
            kind = 0 if label else 1
            once[kind].update(starts.keys())
            often[kind].update(s for s, n in starts.items() if n >= REPEATS)
        names = list(once[0].keys() | once[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[s] for s in names], pa.int64()) for c in (*once, *often)]],
            ["start", *COUNTS])


def train(docs: DataFrame, labels: DataFrame) -> Grammar:
    rows = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = rows.where("toxic = 1").orderBy(*by_hash).limit(TOXIC_ROWS).unionByName(
        rows.where("toxic = 0").orderBy(*by_hash).limit(CLEAN_ROWS))        # bounded: broadcast below
    # of a family the text with the least hash, whatever the partitions; written, so that a lost executor
    # cannot mix two samples
    texts = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
                   .select("text", "toxic", family(F.col("text")).alias("family"))
                   .groupBy("toxic", "family").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
                   .select("text", "toxic").repartition(24), "toxicity_sample")
    seen = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n1, n0 = seen.get(1, 0), seen.get(0, 0)
    if not n1 or not n0:
        return Grammar(FALLBACK, [*FALLBACK_MODEL, 0.0, 0.0])
    gap = lambda a, b: F.col(a) / n1 - F.col(b) / n0
    counts = (texts.mapInArrow(_counted, "start string, " + ", ".join(f"{c} long" for c in COUNTS))
              .groupBy("start").agg(*[F.sum(c).alias(c) for c in COUNTS])
              .withColumn("gap", F.greatest(gap("d1", "d0"), gap("r1", "r0")))
              .where((F.col("d1") >= 4) & (F.col("gap") > 0))
              .orderBy(F.desc("gap"), "start").limit(CANDIDATES).select("start", *COUNTS))
    grammar = Grammar(choose_lexicon([tuple(r) for r in counts.collect()], n1, n0), [])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [grammar.features(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1).cast(pa.int32())],
                                             ["x", "y"])

    fitted = texts.mapInArrow(features, "x array<double>, y int").collect()
    order = sorted((tuple(r["x"]), r["y"]) for r in fitted)             # the same sums on every run
    x, y = np.array([x for x, _ in order]), np.array([y for _, y in order], float)
    grammar.model = logistic(x, y)
    if not x[:, THREATENED].any():         # no evidence: a threat to a target weighs like an insult to one
        grammar.model[1 + THREATENED] = max(grammar.model[1 + AIMED], FALLBACK_MODEL[1 + THREATENED])
    return grammar


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, score of every row, where the row lies (no shuffle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [grammar.score(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    src = docs.select("doc_id", "text")
    out = StructType([src.schema["doc_id"], StructField("score", StructType.fromDDL("s double")[0].dataType)])
    return src.mapInArrow(run, out)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents scored below ``threshold``, every input column."""
    grammar = train(docs, labels)
    columns = [f"`{c}`" for c in docs.columns]
    packed = docs.select(F.struct(*columns).alias("row"), F.col("text").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [grammar.score(t or "") < threshold for t in b.column(1).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return packed.mapInArrow(run, packed.schema).select("row.*")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
