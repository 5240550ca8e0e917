"""Language ID: a linear-chain conditional random field labels each word of a text, also of mixed ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.arrow import annotate
from turnstone.llm.hashing import U, Words, mix, split_words, word_hashes
from turnstone.operators.ordinals import free_name

UNKNOWN = "und"
#: Distinct texts of each language that the model is fitted on at most, and the words taken of each.
SAMPLE_DOCUMENTS = 400
SAMPLE_WORDS = 192
#: Training sequences are so many words; half of them switch from one language to another inside.
SEQUENCE = 32
BUCKETS = 1 << 15
EPOCHS = 4
SEED = 5
#: Words a block of the chain; blocks are multiplied through side by side.
BLOCK = 32
#: A document is rejected if its words' own largest marginals have a mean below this.
LEAST_SCORE = 0.5

_SALTS = {name: U((k + 1) * 0x9E3779B97F4A7C15 % 2**64) for k, name in enumerate(("word", "p1", "p2", "p3", "s1", "s2", "s3", "g2", "g3"))}
_FOLD = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint64)

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_words", T.MapType(T.StringType(), T.LongType()))]
CERTAINTY = T.StructField("certainty", T.DoubleType())


def _bucket(name: str, codes: np.ndarray) -> np.ndarray:
    return (mix(codes + _SALTS[name]) >> U(64 - 15)).astype(np.int64)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For every feature of every word its bucket, and where each word's features start (one more entry).

    Features are the whole word (the lexicon), its first and last one to three bytes (affixes) and its byte
    bigrams and trigrams with the word's ends marked (n-grams), in UTF-8 with A-Z folded.
    """
    starts, ends = words.starts, words.ends
    data = _FOLD[words.data]
    n = len(starts)
    at = lambda i, ok: np.where(ok, data[np.minimum(i, len(data) - 1)], 0)
    fixed = []
    head, tail = np.zeros(n, U), np.zeros(n, U)
    for k in range(3):
        ok = starts + k < ends
        head = head * U(257) + at(starts + k, ok) + U(1)
        tail = tail * U(257) + at(np.maximum(ends - 1 - k, 0), ok) + U(1)
        fixed += [_bucket(f"p{k + 1}", head), _bucket(f"s{k + 1}", tail)]
    whole = np.zeros(n, U)
    powers = np.cumprod(np.full(int((ends - starts).max(initial=1)) + 1, 0x100000001B3, U))
    owner = np.repeat(np.arange(n), ends - starts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
    place = starts[owner] + inside
    if len(place):
        whole = np.add.reduceat((data[place] + U(1)) * powers[inside], np.cumsum(ends - starts) - (ends - starts))
    fixed.append(_bucket("word", whole))
    # a byte's bigram and trigram reach back to the blank before the word, so the start is marked; the last one marks the end
    before = np.where(inside > 0, data[np.maximum(place - 1, 0)], 0)
    before2 = np.where(inside > 1, data[np.maximum(place - 2, 0)], 0)
    grams = [_bucket("g2", before * U(257) + data[place]), _bucket("g3", (before2 * U(257) + before) * U(257) + data[place])]
    size = 7 + 2 * (ends - starts)
    first = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(first[-1], np.int64)
    for k, column in enumerate(fixed):
        out[first[:-1] + k] = column
    for k, column in enumerate(grams):
        out[first[owner] + 7 + 2 * inside + k] = column
    return out, first


def has_letter(words: Words) -> np.ndarray:
    """Which words hold a letter: A-Z, a-z, or, as told by the decoded word, any other alphabetic character."""
    fold = words.data | 0x20
    plain = (fold >= 0x61) & (fold <= 0x7A) & (words.data < 0x80)
    sums = np.concatenate(([0], np.cumsum(plain)))
    found = sums[words.ends] > sums[words.starts]
    wide = np.concatenate(([0], np.cumsum(words.data >= 0x80)))
    for i in np.flatnonzero(~found & (wide[words.ends] > wide[words.starts])):
        found[i] = any(map(str.isalpha, words.data[words.starts[i] : words.ends[i]].tobytes().decode()))
    return found


@dataclass
class Model:
    """Labels, one weight for each feature bucket and label, and one for each transition."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: Words, heard: np.ndarray) -> np.ndarray:
        """Each word's scores; words without a letter (not heard) have none, so their neighbours decide."""
        if not len(words.starts):
            return np.zeros((0, len(self.labels)))
        _, one, place = np.unique(word_hashes(words), return_index=True, return_inverse=True)
        distinct = words._replace(starts=words.starts[one], ends=words.ends[one])
        buckets, first = features(distinct)
        scores = np.add.reduceat(self.weights[buckets], first[:-1])
        scores /= np.sqrt(np.diff(first))[:, None]
        scores[~heard[one]] = 0
        return scores[place]


def posteriors(emissions: np.ndarray, bounds: np.ndarray, transitions: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Forward-backward over each text's words (bounds: its first word, one more entry): every word's marginals.

    Texts are cut into blocks. All blocks' transfer matrices are multiplied out side by side, messages run from
    block to block, then words' messages run inside all blocks side by side; the result is that of one pass.
    """
    n, size = emissions.shape
    if not n:
        return emissions
    counts = np.diff(bounds)
    blocks = -(-counts // block)
    top = np.concatenate(([0], np.cumsum(blocks)))
    total = int(top[-1])
    text = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(n) - bounds[text]
    row, col = top[text] + inside // block, inside % block
    scale = np.exp(emissions - emissions.max(1, keepdims=True))
    psi = np.ones((total, block, size))
    psi[row, col] = scale
    real = np.zeros((total, block, 1), bool)
    real[row, col] = True
    step = np.exp(transitions - transitions.max())
    carry = np.broadcast_to(np.eye(size), (total, size, size))
    for k in range(block):
        moved = (carry @ step) * psi[:, k, None, :]
        moved /= moved.sum((1, 2), keepdims=True)
        carry = np.where(real[:, k, :, None], moved, carry)
    into = np.full((total, size), 1 / size)
    onward = np.full((total, size), 1 / size)
    for j in range(int(blocks.max(initial=1)) - 1):
        live = np.flatnonzero(blocks > j + 1)
        message = np.einsum("bi,bij->bj", into[top[live] + j], carry[top[live] + j])
        into[top[live] + j + 1] = message / message.sum(1, keepdims=True)
        last = top[live] + blocks[live] - 1 - j
        message = np.einsum("bij,bj->bi", carry[last], onward[last])
        onward[last - 1] = message / message.sum(1, keepdims=True)
    forward = np.empty_like(psi)
    message = into
    for k in range(block):
        moved = (message @ step) * psi[:, k]
        moved /= moved.sum(1, keepdims=True)
        message = np.where(real[:, k], moved, message)
        forward[:, k] = message
    message = onward
    for k in range(block - 1, -1, -1):
        forward[:, k] *= message
        moved = (psi[:, k] * message) @ step.T
        moved /= moved.sum(1, keepdims=True)
        message = np.where(real[:, k], moved, message)
    found = forward[row, col]
    return found / found.sum(1, keepdims=True)


def train(sequences: Sequence[tuple[list[bytes], list[int]]], labels: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fit the field to labelled word sequences of one length by the exact gradient of their likelihood (AdaGrad)."""
    rng = np.random.default_rng(seed)
    size = len(labels)
    model = Model(labels, np.zeros((BUCKETS, size)), np.zeros((size, size)))
    seen_w, seen_t = np.full((BUCKETS, size), 1e-3), np.full((size, size), 1e-3)
    made = []
    for tokens, gold in sequences:
        words = split_words([b" ".join(tokens)])
        buckets, first = features(words)
        made.append((buckets, np.diff(first), np.array(gold), has_letter(words)))
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(made)), max(1, len(made) // 48)):
            group = [made[i] for i in batch]
            buckets = np.concatenate([g[0] for g in group])
            sizes = np.concatenate([g[1] for g in group])
            gold = np.stack([g[2] for g in group])
            heard = np.stack([g[3] for g in group])
            norm = 1 / np.sqrt(sizes)
            starts = np.cumsum(sizes) - sizes
            scores = np.add.reduceat(model.weights[buckets], starts) * norm[:, None]
            scores = scores.reshape(*gold.shape, size) * heard[..., None]
            grad_e, grad_t = _gradient(scores, gold, model.transitions)
            flat = (grad_e * heard[..., None]).reshape(-1, size) * norm[:, None]
            spread = np.repeat(flat, sizes, axis=0)
            step = np.stack([np.bincount(buckets, spread[:, k], BUCKETS) for k in range(size)], 1) + 1e-4 * model.weights
            seen_w += step * step
            model.weights -= 0.2 * step / np.sqrt(seen_w)
            seen_t += grad_t * grad_t
            model.transitions -= 0.1 * grad_t / np.sqrt(seen_t)
    return model


def _gradient(scores: np.ndarray, gold: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean negative log likelihood of sequences (batch, word, label) with the labels gold."""
    batch, length, size = scores.shape
    psi = np.exp(scores - scores.max(2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(psi), np.empty_like(psi)
    message = np.full((batch, size), 1 / size)
    for k in range(length):
        message = (message @ step) * psi[:, k]
        message /= message.sum(1, keepdims=True)
        forward[:, k] = message
    message = np.full((batch, size), 1 / size)
    for k in range(length - 1, -1, -1):
        backward[:, k] = message
        message = (psi[:, k] * message) @ step.T
        message /= message.sum(1, keepdims=True)
    marginal = forward * backward
    marginal /= marginal.sum(2, keepdims=True)
    ahead = psi[:, 1:] * backward[:, 1:]
    pair = forward[:, :-1, :, None] * step * ahead[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    true = np.eye(size)[gold]
    grad_t = pair.sum((0, 1)) - np.einsum("bki,bkj->ij", true[:, :-1], true[:, 1:])
    return (marginal - true) / batch, grad_t / (batch * (length - 1))


def held_out(doc_id):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2, F.lit(False))


def sample_sequences(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, words: int = SAMPLE_WORDS, seed: int = SEED) -> tuple[list, list[str]]:
    """Labelled sequences of the languages' sample documents: `documents` a language at most, `words` of each.

    They are the first distinct texts of the language by a hash of the text, copies counting once and blank texts
    not at all; any language with a text has some. A share of the hashes is read at first, more if that has too few.

    A sequence has SEQUENCE words; half of them go over from one document to one in another language.
    """
    spoken = F.col("lang").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    known = docs.where(spoken & ~held_out(F.col("doc_id"))).select("lang", "text", F.xxhash64("text").alias("o"))
    sizes = {r["lang"]: r["count"] for r in known.select("lang", "o").distinct().groupBy("lang").count().collect()}
    cut = F.slice(F.split(F.trim("text"), r"[\x20\x09-\x0D]+"), 1, words)
    texts: dict[str, list[list[bytes]]] = {}
    shares = {lang: min(1.0, 2 * documents / n) for lang, n in sizes.items()}
    while shares:
        reach = F.create_map(*[F.lit(x).cast("long" if isinstance(x, int) else "string") for lang, share in shares.items() for x in (lang, min(2**63 - 1, int(share * 2**64) - 2**63))])
        rows = known.where(F.col("o") <= reach[F.col("lang")]).dropDuplicates(["lang", "o"]).select("lang", "o", cut.alias("w")).collect()
        found: dict[str, list] = {lang: [] for lang in shares}
        for r in rows:
            found[r["lang"]].append((r["o"], r["w"]))
        for lang, mine in found.items():
            if len(mine) >= min(documents, sizes[lang]):
                texts[lang] = [[w.encode() for w in ws if w] for _, ws in sorted(mine)[:documents]]
        shares = {lang: min(1.0, 4 * share) for lang, share in shares.items() if lang not in texts}
    labels = sorted(texts)
    rng = np.random.default_rng(seed)
    pieces = []
    for k, lang in enumerate(labels):
        for tokens in texts[lang]:
            pieces += [(tokens[i : i + SEQUENCE], k) for i in range(0, len(tokens) - SEQUENCE + 1, SEQUENCE)]
            if len(tokens) < SEQUENCE and tokens:
                pieces.append(((tokens * SEQUENCE)[:SEQUENCE], k))
    out = []
    for i in rng.permutation(len(pieces)):
        tokens, k = pieces[i]
        gold = [k] * SEQUENCE
        if rng.random() < 0.5:
            other, j = pieces[rng.integers(len(pieces))]
            at = int(rng.integers(4, SEQUENCE - 4))
            tokens, gold = tokens[:at] + other[at:], [k] * at + [j] * (SEQUENCE - at)
        out.append((tokens, gold))
    return out, labels


def fit(docs: DataFrame, **options) -> Model | None:
    """The field, learned from a bounded sample of documents with a language; None where there is none."""
    sequences, labels = sample_sequences(docs, **options)
    return train(sequences, labels) if sequences else None


def predictor(model: Model | None) -> Callable[[list[bytes | None]], list[list]]:
    """A function from texts to language, score, the number of words of each language, and certainty."""

    def predict(texts: list[bytes | None]) -> list[list]:
        words = split_words(texts)
        heard = has_letter(words)
        if model is None:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts), [{} for _ in texts], [0.0] * len(texts)]
        found = posteriors(model.emissions(words, heard), words.bounds, model.transitions) * heard[:, None]
        sums = np.concatenate((np.zeros((1, len(model.labels))), np.cumsum(found, 0)))
        totals = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
        letters = np.concatenate(([0], np.cumsum(heard)))
        n = letters[words.bounds[1:]] - letters[words.bounds[:-1]]
        best = totals.argmax(1)
        score = np.clip(totals[np.arange(len(texts)), best] / np.maximum(n, 1), 0, 1)
        sure = np.concatenate(([0.0], np.cumsum(found.max(1))))
        sure = np.clip((sure[words.bounds[1:]] - sure[words.bounds[:-1]]) / np.maximum(n, 1), 0, 1)
        votes = np.eye(len(model.labels), dtype=np.int64)[found.argmax(1)] * heard[:, None]
        votes = np.concatenate((np.zeros((1, len(model.labels)), np.int64), np.cumsum(votes, 0)))
        counts = votes[words.bounds[1:]] - votes[words.bounds[:-1]]
        langs = [model.labels[k] if m else UNKNOWN for k, m in zip(best, n, strict=True)]
        by_lang = [{lang: c for lang, c in zip(model.labels, row, strict=True) if c} for row in counts.tolist()]
        plain = lambda values: [float(v) if m else 0.0 for v, m in zip(values, n, strict=True)]
        return [langs, plain(score), by_lang, plain(sure)]

    return predict


def identify(docs: DataFrame, model: Model | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs with lang_pred, score, lang_words (words of each language, by their own marginals) and certainty.

    Each word of the whole text gets marginals by forward-backward; the language is the one with the largest sum
    over words with a letter, score their mean marginal of it, and certainty the mean of each one's own largest
    marginal, which a text in several languages has too. Map side only. Without a model, one is fitted
    on docs: a bounded sample of rows with a language, held-out rows left out. Prediction reads only text.

    A null text, or one without a letter, is 'und' with score 0, and so is everything if nothing could be learned;
    ties go to the language first by name; repeated rows give repeated results; an empty table gives no rows;
    columns named like a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    return annotate(docs, "text", lambda: predictor(shared.value), [*FIELDS, CERTAINTY], keep)


def report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score."""
    found = identify(docs.select("doc_id", "text", "lang"), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """docs without those that have no language by name or a certainty under LEAST_SCORE, with their own columns.

    Texts in several languages stay if their words are labelled with certainty.
    """
    names = {f.name for f in (*FIELDS, CERTAINTY)}
    hidden = {c: free_name(docs, f"own_{c.lower()}") for c in docs.columns if c.lower() in names}
    found = identify(docs.withColumnsRenamed(hidden), fit(docs))
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("certainty") >= LEAST_SCORE)).drop(*names)
    return kept.withColumnsRenamed({v: k for k, v in hidden.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])
