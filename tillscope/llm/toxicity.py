"""Toxicity by a grammar of weighted finite-state transducers over clauses.

A lexicon of insult stems is learned from labelled documents; it turns the words of a clause into
kinds (insult, threat, target, negation, report, future) and gives each match its log odds. Behind
it, transducers read the kinds: a negation shortly before a match weakens it, a report earlier in the
clause does, a threat needs a future verb, and only a match with a target near it counts in
full. Those that look to the left are composed into one machine; the target's reads
the clause in both directions. What all clauses add to the prior is the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.llm.common import alnum_words, only, saved

#: Word classes of the grammar, in the languages of the corpus.
THREATS = frozenset("kill murder stab shoot strangle beat hurt destroy burn töten umbringen schlagen tuer frapper matar golpear".split())
FUTURE = frozenset("will gonna shall must should werde wird vais va voy".split())
TARGETS = frozenset("you your yours he she they them him her people du dich ihr sie tu toi vous ils usted ustedes tú ellos".split())
NEGATIONS = frozenset("not never isn't aren't wasn't don't nicht kein keine niemals jamais nunca".split())
SPEECH = frozenset("said says wrote writes called calls quoted quotes claimed claims sagte schrieb nannte disait écrivait appelé dijo escribió llamó".split())

#: Common insults, whole words (or with an s), and the log odds of each.
INSULTS = dict.fromkeys("""bastard clown coward cretin disgusting dumb fool garbage idiot imbecile jerk loser
 moron pathetic scum stupid trash vermin worthless abschaum blödmann dummkopf trottel versager abruti connard
 crétin imbécile salaud basura cabrón estúpido imbécil inútil""".split(), 3.5)

#: Labelled documents that the lexicon is learned from, at most about.
SAMPLE = 12_000
#: Lengths of stems, and what one needs: different toxic documents, log odds, and a likelihood
#: ratio that chance among some thousands of stems hardly explains.
STEM, LEAST_DOCS, LEAST_ODDS, LEAST_RATIO = range(3, 9), 3, 1.5, 18.0
#: Log odds of a threat and of a text without a lexicon, and the factors of the transducers.
#: With UNAIMED one insult without a target stays below TOXIC; more of them can pass it.
THREAT_ODDS, PRIOR, AIMED, UNAIMED, NEGATED, REPORTED = 3.0, -2.0, 1.0, 0.35, 0.2, 0.3
#: Kinds of words, the alphabet of the transducers.
KINDS = OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, AHEAD = range(7)
TOXIC = 0.7

CLAUSE = re.compile(r"[.!?;\n]+")
WORD = re.compile(r"[\w']+")


def may_train(id_col: str = "doc_id"):
    """Rows whose labels may be learned from."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(3)) != 1


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, kin, words): a bounded sample of the labelled documents that may be learned from.

    kin is a hash of all different words, in any order: each different text is one observation,
    and a document of many copies counts once.
    """
    rows = only(labels, doc_id="doc_id", toxic="toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(may_train())
    n = rows.count()
    share = min(1.0, SAMPLE / n) if n else 1.0
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = only(docs, doc_id="doc_id", text="text")
    # Bounded by SAMPLE rows of two numbers.
    texts = texts.join(F.broadcast(drawn), "doc_id")
    words = texts.select("toxic", F.array_distinct(alnum_words("text")).alias("words")).filter(F.size("words") > 0)
    return words.select("toxic", F.xxhash64(F.array_sort("words")).alias("kin"), "words")


def likelihood_ratio(t: int, c: int, toxic: int, clean: int) -> float:
    """Twice the log likelihood ratio of "as frequent in both" against what was counted."""
    def part(k: int, n: int, share: float) -> float:
        return k * math.log(k / (n * share)) if k else 0.0

    share = (t + c) / (toxic + clean)
    return 2 * (
        part(t, toxic, share) + part(c, clean, share)
        + part(toxic - t, toxic, 1 - share) + part(clean - c, clean, 1 - share)
    )


def lexicon(docs: DataFrame, labels: DataFrame) -> tuple[float, dict[str, float]]:
    """(log odds of a text without any match, log odds by stem).

    A stem is the beginning of a word that toxic documents have far more often than clean ones.
    Of stems that begin one another the one that tells most is kept, the longest of equals.
    At most 5,000 counts of a bounded sample come to the driver.
    """
    rows = saved(labelled(docs, labels), "labelled")
    seen = {bool(r["toxic"]): r["n"] for r in rows.groupBy("toxic").agg(F.countDistinct("kin").alias("n")).collect()}
    toxic, clean = seen.get(True, 0), seen.get(False, 0)
    if not toxic or not clean:
        return PRIOR, {}
    stems = F.array_distinct(F.flatten(F.transform(
        "words", lambda w: F.transform(F.array(*map(F.lit, STEM)), lambda k: F.substr(w, F.lit(1), k))
    )))
    counts = rows.select("toxic", "kin", F.explode(stems).alias("stem")).filter(F.length("stem") >= min(STEM))
    counts = counts.groupBy("stem").agg(
        F.countDistinct(F.when(F.col("toxic") == 1, F.col("kin"))).alias("t"),
        F.countDistinct(F.when(F.col("toxic") != 1, F.col("kin"))).alias("c"),
    )
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    kept = counts.withColumn("odds", odds).filter((F.col("t") >= LEAST_DOCS) & (F.col("odds") >= LEAST_ODDS))
    telling = []
    for r in kept.orderBy(F.desc("t"), "stem").limit(5000).collect():
        ratio = likelihood_ratio(min(r["t"], toxic), min(r["c"], clean), toxic, clean)
        if ratio >= LEAST_RATIO:
            telling.append((-ratio, -len(r["stem"]), r["stem"], r["odds"]))
    found: dict[str, float] = {}
    for _, _, stem, weight in sorted(telling):
        if not any(stem.startswith(o) or o.startswith(stem) for o in found):
            found[stem] = weight
    return math.log(toxic / clean), dict(sorted(found.items()))


class Transducer:
    """A weighted finite-state transducer over kinds of words.

    `step[state][kind]` is the next state and `weight[state][kind]` the factor that a match of
    that kind gets; state 0 is the start.
    """

    def __init__(self, step: list[list[int]], weight: list[list[float]]):
        self.step, self.weight = step, weight

    def read(self, kinds: list[int]) -> list[float]:
        state, out = 0, []
        for kind in kinds:
            out.append(self.weight[state][kind])
            state = self.step[state][kind]
        return out


def within(opener: int, reach: int, inside: float, outside: float, matches: tuple[int, ...]) -> Transducer:
    """Matches at most `reach` words behind an opener get the factor `inside`, others `outside`."""
    step = [[reach if kind == opener else max(left - 1, 0) for kind in KINDS] for left in range(reach + 1)]
    weight = [[(inside if left else outside) if kind in matches else 1.0 for kind in KINDS] for left in range(reach + 1)]
    return Transducer(step, weight)


def composed(machines: list[Transducer]) -> Transducer:
    """One transducer that reads as all of them do at once: its states are the combinations that
    can be reached, its weights the products."""
    start = (0,) * len(machines)
    number, queue, step, weight = {start: 0}, [start], [], []
    for states in queue:
        step.append([])
        weight.append([])
        for kind in KINDS:
            ahead = tuple(m.step[q][kind] for m, q in zip(machines, states))
            if ahead not in number:
                number[ahead] = len(number)
                queue.append(ahead)
            step[-1].append(number[ahead])
            weight[-1].append(math.prod(m.weight[q][kind] for m, q in zip(machines, states)))
    return Transducer(step, weight)


class Grammar:
    """The patterns for one lexicon: lexicon, then contexts, then targets on either side.

    The contexts to the left of a match (negation, report, future) are one composed transducer.
    A target may stand on either side, so its transducer reads the clause in both directions and the
    better of the two weights counts.
    """

    def __init__(self, prior: float, stems: dict[str, float]):
        self.prior, self.weight = prior, stems
        whole = "|".join(map(re.escape, sorted({*THREATS, *INSULTS})))
        begun = "".join("|" + re.escape(s) for s in sorted(stems))
        self.opens = re.compile(rf"\b(?:(?:{whole})s?\b{begun})")
        self.lengths = sorted({len(s) for s in stems})
        classes = [(NEGATION, NEGATIONS), (REPORT, SPEECH), (AHEAD, FUTURE), (TARGET, TARGETS)]
        self.kinds = {word: kind for kind, words in classes for word in words}
        both = (INSULT, THREAT)
        self.left = composed([
            within(NEGATION, 2, NEGATED, 1.0, both),
            within(REPORT, 6, REPORTED, 1.0, both),
            within(AHEAD, 3, 1.0, 0.0, (THREAT,)),
        ])
        self.aim = within(TARGET, 3, AIMED, UNAIMED, both)

    def insult(self, word: str) -> float:
        learned = max((self.weight.get(word[:k], 0.0) for k in self.lengths), default=0.0)
        return max(learned, INSULTS.get(word, 0.0), INSULTS.get(word.removesuffix("s"), 0.0))

    def lexical(self, word: str) -> tuple[int, float]:
        """The kind of a word, and the weight of a match that it opens."""
        if word in self.kinds:
            return self.kinds[word], 0.0
        weight = self.insult(word)
        if weight:
            return INSULT, weight
        return (THREAT, THREAT_ODDS) if word in THREATS else (OTHER, 0.0)

    def clause(self, words: list[str]) -> float:
        """Log odds that a clause adds: the weights of its matches through all transducers."""
        read = [self.lexical(word) for word in words]
        kinds = [kind for kind, _ in read]
        aim = map(max, self.aim.read(kinds), reversed(self.aim.read(kinds[::-1])))
        return sum(w * f * a for (_, w), f, a in zip(read, self.left.read(kinds), aim) if w)

    def score(self, text: str) -> float:
        """0 to 1. Only clauses in which a stem or a threat begins a word are read word by word."""
        lowered, total, done = text.lower(), self.prior, -1
        for found in self.opens.finditer(lowered):
            if found.start() < done:
                continue
            ahead = CLAUSE.search(lowered, found.end())
            done = ahead.start() if ahead else len(lowered)
            begin = max(lowered.rfind(c, 0, found.start()) for c in ".!?;\n") + 1
            total += self.clause(WORD.findall(lowered, begin, done))
        return 1 / (1 + math.exp(-max(min(total, 30.0), -30.0)))


def scored(docs: DataFrame, prior: float, stems: dict[str, float], id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, score) of every row; NULL, empty and wordless texts have the prior's score.

    Repeated rows are repeated, an empty table gives an empty result. Without a lexicon only
    threats are found.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    grammar = Grammar(prior, stems)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.array([grammar.score(t.as_py() or "") for t in batch.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, kind)
