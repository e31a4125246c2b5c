"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public vocabulary. A word's probability is the sum over
all ways to cut it into pieces, found by a forward algorithm; a text's is the product over its words. The pieces'
probabilities are fitted by expectation maximisation (forward and backward sums over all segmentations) on a bounded
sample of labelled texts; the prediction is the language with the largest posterior. All words of the sample count: they
are a table, each round's expected uses are summed in tasks, and only the pieces' sums reach the driver.

Words are maximal runs of letters, lower-cased, cut every ``RUN`` letters so that no product underflows. Whole texts
count, very long ones in parts; each worker remembers the scores of words that it has seen. The score is the posterior
of the whole text's words, so it is close to 1 for all but short texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any labelled text everything
is ``und``; ties go to the language that sorts first; letters that training never saw have one small probability in
every language; repeated rows are rows; an empty table gives no rows; extra columns, whatever their names, are never
read by the operator and stay where they are.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm.common import Scratch, released, small_batches, table

VOCABULARY = "piece_bpe_32k.model"
#: Labelled texts per language that the fit reads, about.
SAMPLE_DOCS = 400
RUN = 32
UNSEEN = 1e-7
#: Word scores that a worker remembers; words that are looked up at once, and of them those whose arcs are held at once.
REMEMBERED, AT_ONCE, LATTICE = 400_000, 200_000, 4_000
WORDS = re.compile(rf"[^\W\d_]{{1,{RUN}}}")
UND = "und"


def vocabulary_pieces(path: str | None = None) -> list[str]:
    """The pieces of letters, with a leading mark where a word begins; lower case."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if re.fullmatch(r"▁?[^\W\d_]+", p))


@dataclass
class Lattice:
    """All arcs (piece matches) of some words, as arrays ordered by their end."""

    n_words: int
    word: np.ndarray
    start: np.ndarray
    piece: np.ndarray
    end: np.ndarray
    lengths: np.ndarray


class Model:
    """``pieces``: index by piece; ``p``: a row per piece, the last for unseen letters, a column per language."""

    def __init__(self, languages: list[str], pieces: dict[str, int], p: np.ndarray):
        self.languages, self.pieces, self.p = languages, pieces, p

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "beginnings"}  # made anew on each worker

    @functools.cached_property
    def beginnings(self) -> frozenset:
        """What pieces begin with: where a text leaves it, no longer piece can match."""
        return frozenset(p[:n] for p in self.pieces for n in range(1, len(p) + 1))

    def lattice(self, words: list[str]) -> Lattice:
        get, unseen, beginnings = self.pieces.get, len(self.pieces), self.beginnings
        word, start, piece, end = [], [], [], []
        lengths = np.empty(len(words), np.int64)
        for w, text in enumerate(words):
            text = "▁" + text
            n = len(text)
            lengths[w] = n
            for i in range(n):
                single = True
                for j in range(i + 1, n + 1):
                    part = text[i:j]
                    if part not in beginnings:
                        break
                    k = get(part)
                    if k is not None:
                        word.append(w)
                        start.append(i)
                        piece.append(k)
                        end.append(j)
                        single = single and j > i + 1
                if single:  # no piece of this one letter
                    word.append(w)
                    start.append(i)
                    piece.append(unseen)
                    end.append(i + 1)
        a = [np.array(x, np.int64) for x in (word, start, piece, end)]
        order = np.argsort(a[3], kind="stable")
        return Lattice(len(words), *(x[order] for x in a), lengths)

    def forward(self, lat: Lattice) -> np.ndarray:
        """Summed probability of all segmentations of each prefix: [word, length, language]."""
        most = int(lat.lengths.max(initial=0))
        alpha = np.zeros((lat.n_words, most + 1, len(self.languages)))
        alpha[:, 0] = 1
        cuts = np.searchsorted(lat.end, np.arange(1, most + 2))
        for e in range(1, most + 1):
            s = slice(cuts[e - 1], cuts[e])
            w = lat.word[s]
            if len(w):  # arcs of one end are in the order of their words
                first = np.r_[0, np.flatnonzero(np.diff(w)) + 1]
                alpha[w[first], e] = np.add.reduceat(alpha[w, lat.start[s]] * self.p[lat.piece[s]], first, axis=0)
        return alpha

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.empty((len(words), len(self.languages)))
        for at in range(0, len(words), LATTICE):
            part = words[at : at + LATTICE]
            lat = self.lattice(part)
            out[at : at + len(part)] = np.log(np.maximum(self.forward(lat)[np.arange(len(part)), lat.lengths], 1e-300))
        return out

    def expected(self, lat: Lattice, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in each language: forward times backward sums."""
        alpha = self.forward(lat)
        beta = np.zeros_like(alpha)
        rows = np.arange(lat.n_words)
        beta[rows, lat.lengths] = 1
        order = np.lexsort((lat.word, lat.start))
        word, start, piece, end = (x[order] for x in (lat.word, lat.start, lat.piece, lat.end))
        most = alpha.shape[1] - 1
        cuts = np.searchsorted(start, np.arange(most + 2))
        for b in range(most - 1, -1, -1):
            s = slice(cuts[b], cuts[b + 1])
            w = word[s]
            if len(w):
                first = np.r_[0, np.flatnonzero(np.diff(w)) + 1]
                beta[w[first], b] = np.add.reduceat(beta[w, end[s]] * self.p[piece[s]], first, axis=0)
        total = np.maximum(alpha[rows, lat.lengths], 1e-300)
        use = alpha[word, start] * self.p[piece] * beta[word, end] / total[word] * counts[word]
        out = np.zeros_like(self.p)
        np.add.at(out, piece, use)
        return out


def fit(docs: DataFrame, languages: list[str], pieces: list[str], rounds: int = 3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on all words of about ``sample_docs`` of the given labelled texts per language, drawn by a hash of the id."""
    sizes = {r[0]: r[1] for r in docs.groupBy(lang_col).count().collect()}
    rate = F.element_at(F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample_docs / v)))]), F.col(lang_col))
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1 << 30)) / float(1 << 30) < rate
    found = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(rf"(\p{{L}}{{1,{RUN}}})"), F.lit(1)))
    rows = docs.where(drawn).select(F.col(lang_col).alias("lang"), found.alias("w"))
    scratch = Scratch(docs.sparkSession, "langid")
    counted = rows.groupBy("w").agg(F.array(*[F.count_if(F.col("lang") == x) for x in languages]).alias("n"))
    words = scratch.write(counted.repartition(docs.sparkSession.sparkContext.defaultParallelism, "w"), "words")
    index = {p: i for i, p in enumerate(pieces)}
    letters = {r[0] for r in words.select(F.explode(F.split("w", ""))).distinct().collect()}  # no more than there are letters
    for c in sorted({c for c in letters if WORDS.fullmatch(c)} | {"▁"}):
        index.setdefault(c, len(index))
    model = Model(languages, index, np.full((len(index) + 1, len(languages)), 1.0 / (len(index) + 1)))
    for _ in range(rounds):
        use = np.full_like(model.p, 0.02)
        sums = words.mapInPandas(released(_uses(model)), "piece long, lang long, used long").groupBy("piece", "lang").agg(F.sum("used").alias("used")).toPandas()
        use[sums["piece"], sums["lang"]] += sums["used"].to_numpy() / FIXED
        model.p = use / use.sum(axis=0)
        model.p[-1] = UNSEEN
    scratch.close()
    return model


#: Uses are summed as whole numbers of so small parts, so their order does not matter.
FIXED = 1e6


def _uses(model: Model):
    """Words with their counts per language to the expected uses of each piece, summed in each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = np.zeros_like(model.p)
        for pdf in batches:
            pdf = pdf[pdf["w"].map(lambda w: WORDS.fullmatch(w) is not None).astype(bool)]
            for at in range(0, len(pdf), 20_000):
                part = pdf.iloc[at : at + 20_000]
                use += model.expected(model.lattice(part["w"].tolist()), np.stack(part["n"].to_list()).astype(float))
        used = np.rint(use * FIXED).astype(np.int64)
        piece, lang = np.nonzero(used)
        yield pd.DataFrame({"piece": piece, "lang": lang, "used": used[piece, lang]})

    return run


class Scorer:
    """Scores texts with a bounded memory of words."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.known = np.empty((REMEMBERED, len(model.languages)))

    def _places(self, words: list[str]) -> np.ndarray:
        new = list(set(words) - self.place.keys())
        if len(self.place) + len(new) > REMEMBERED:
            self.place.clear()
            new = list(set(words))
        at = len(self.place)
        self.known[at : at + len(new)] = self.model.score(new)
        self.place.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        totals = np.zeros((len(texts), len(self.model.languages)))
        some = np.zeros(len(texts), bool)
        for docs, words in self._groups(texts):
            places = self._places(words)
            np.add.at(totals, np.array([d for d, _ in docs]), np.add.reduceat(self.known[places], np.cumsum([0] + [n for _, n in docs][:-1]), axis=0))
            some[[d for d, _ in docs]] = True
        totals -= totals.max(axis=1, keepdims=True)
        p = np.exp(totals)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = [self.model.languages[b] if s else UND for b, s in zip(best, some, strict=True)]
        return names, np.where(some, p[np.arange(len(p)), best], 0.0)

    @staticmethod
    def _groups(texts: list[str | None]) -> Iterator[tuple[list[tuple[int, int]], list[str]]]:
        """Documents (number, words of it) and their words, at most ``AT_ONCE`` words; a long text spans several."""
        docs, words = [], []
        for i, t in enumerate(texts):
            found = WORDS.findall(t.lower()) if isinstance(t, str) else []
            if not any(c.isalpha() for w in found for c in w):  # superscripts and the like alone are no letters
                found = []
            for at in range(0, len(found), AT_ONCE):
                part = found[at : at + AT_ONCE]
                if words and len(words) + len(part) > AT_ONCE:
                    yield docs, words
                    docs, words = [], []
                docs.append((i, len(part)))
                words += part
        if words:
            yield docs, words


def predictor(model: Model | None):
    """A pandas UDF: text to ``struct<lang_pred string, score double>``."""

    def run(texts):
        scorer = Scorer(model) if model else None
        for s in texts:
            if scorer is None:
                yield pd.DataFrame({"lang_pred": [UND] * len(s), "score": 0.0})
            else:
                names, scores = scorer(s.tolist())
                yield pd.DataFrame({"lang_pred": names, "score": scores})

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from released(run)(texts)

    return predict


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, vocabulary: str | None = None, **columns) -> Model | None:
    """The model of those rows of ``docs`` that have a text and a language and are not held out; None without any."""
    lang, text, key = columns.get("lang_col", "lang"), columns.get("text_col", "text"), columns.get("id_col", "doc_id")
    own = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & ~held_out(F.col(key)))
    languages = sorted(r[0] for r in own.select(lang).distinct().collect())
    return fit(own, languages, vocabulary_pieces(vocabulary), **columns) if languages else None


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> Column:
    """The column ``struct(lang_pred, score)`` for ``docs``."""
    small_batches(docs.sparkSession)
    return predictor(model)(F.col(text_col))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    p = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(docs, model).alias("p"))
    return p.select("doc_id", "held_out", "p.lang_pred", "p.score")
