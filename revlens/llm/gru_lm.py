"""Language-model scores: a gated recurrent network in numpy with a
class-factored softmax, trained by truncated backpropagation.

*Counts.*  Words (and one end per text) are counted over all training texts:
per task in a dictionary, then summed by hash.  They give the unigram base
score and the vocabulary of the model.  The HEAD most frequent words are
classes of the softmax with members of their own; all other words belong to
one of TAILS classes by their last two bytes, and their probability within the class is the unigram one, (c + 0.5) / (class total + 0.5 (class kinds + 1)),
where one more kind stands for all words unseen in training.

*Model.*  h = GRU(word), P(word) = P(class | h) P(word | class, h).  Only head
classes have a softmax of their own over their HEAD / CLASSES members.  All
parameters together are a few hundred kilobytes whatever the corpus.

*Coding.*  The texts are read twice: once for the counts, once to write every
text as ids of the network's inputs (two bytes a word), with all parts of the
scores that do not depend on the network.  Training and scoring read the ids.

*Training.*  Every window of STEPS words of every training text is trained on.
A task reads its texts in lanes (at most LANES, fewer where a batch has few
words, so that small inputs get as many updates); a lane takes one text after
another, and the state is carried from window to window of a text and starts
at zero with the next.  Each of ROUNDS rounds takes the training texts of one
hash class; every task starts from the common weights and the common sums of
squared gradients (Adagrad), and both are averaged by the words that the tasks
saw, in two steps on the executors.  A round's weights are kept only if they
do not score worse on the training texts of one hash class in JUDGES.

*Scoring.*  A task scores all its texts in lock step, longest first; the state
is carried across windows, so a score is the log10 probability of the complete
text.  Counts of the KNOWN most frequent words are broadcast (a bound by
count, not by corpus); the base score's other words are joined with the counts
by hash.

NULL texts are empty: their only token is the end.  Rows with a NULL id are
training texts.  Repeated rows count each time.  Without training texts the
model is uniform over the end and unseen words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import stored, summed_vectors
from revlens.llm.text import SPACED, hashed_words, utf8

HEAD = 1024
CLASSES = 32
TAILS = 32
HIDDEN = 12
STEPS = 32
ROUNDS = 3
RATE = 0.05
LANES = 256
#: Words of a batch for each lane; a lane is one row of an update.
LANE_WORDS = 4096
#: One in JUDGES training texts judges each round's weights.
JUDGES = 128
KNOWN = 1 << 19
#: Rows of logits that stay in a core's cache.
CACHED = 1024
SEED = 11

END = np.uint64(int.from_bytes(hashlib.blake2b(b"end of text", digest_size=8).digest(), "little"))


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text followed by the end, and offsets."""
    hashes, at = hashed_words(texts, SPACED, lower=True, ending=True)
    out = np.insert(hashes, at[1:], END)
    return out, at + np.arange(len(at))


def word_counts(docs: DataFrame) -> DataFrame:
    """hash, n of every word of the texts."""

    def run(batches):
        for batch in batches:
            kinds, n = np.unique(_tokens(utf8(batch.column("text")))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return docs.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Classes of words and the counts that tasks hold; fixed size."""

    def __init__(self, known: np.ndarray, counts: np.ndarray, tail_n: np.ndarray, tail_kinds: np.ndarray,
                 total: int, kinds: int):
        order = np.argsort(known)
        self.known, self.counts = known[order], counts[order]
        head = np.lexsort((known, -counts))[:HEAD]
        self.head = np.sort(known[head])
        self.head_counts = counts[head][np.argsort(known[head])]
        # Members by frequency, so that classes hold words of like frequency.
        by_count = np.lexsort((self.head, -self.head_counts))
        self.member = np.full(len(self.head), 0)
        self.member[by_count] = np.arange(len(self.head))
        self.width = HEAD // CLASSES
        self.tail_n, self.tail_kinds = tail_n, tail_kinds
        self.total, self.kinds = total, kinds

    def head_slot(self, hashes: np.ndarray) -> np.ndarray:
        """Place among the head words, by frequency; -1 for others."""
        if not len(self.head):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
        return np.where(self.head[at] == hashes, self.member[at], -1)

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Training count of the known words; 0 for others."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.counts[at], 0)


def tail_class(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(59)).astype(np.int64) % TAILS


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the word counts; the driver gets at most KNOWN words and a
    histogram of counts below the bound."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).first()
    # Least count such that at most KNOWN words reach it.
    scale = counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("step")).agg(
        F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    bound, words = 1 << 62, 0
    for r in scale:
        if words + r["words"] > KNOWN:
            break
        bound, words = r["least"], words + r["words"]
    known = counts.where(F.col("n") >= bound).toArrow()
    hashes = known.column("hash").to_numpy().view(np.uint64)
    held = known.column("n").to_numpy().astype(np.int64)
    head = set(hashes[np.lexsort((hashes, -held))[:HEAD]].view(np.int64).tolist())
    shift = F.shiftrightunsigned("hash", 59) % TAILS
    tail_n, tail_kinds = np.zeros(TAILS), np.zeros(TAILS)
    for r in counts.groupBy(shift.cast("int").alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():
        tail_n[r["tail"]], tail_kinds[r["tail"]] = r["n"], r["k"]
    own = tail_class(hashes)
    is_head = np.isin(hashes.view(np.int64), np.fromiter(head, np.int64, len(head)))
    tail_n -= np.bincount(own[is_head], held[is_head], TAILS)
    tail_kinds -= np.bincount(own[is_head], minlength=TAILS)
    return Vocabulary(hashes, held, tail_n, tail_kinds, int(totals["n"] or 0), int(totals["kinds"]))


class Network:
    """Parameters in one flat vector."""

    def __init__(self, vocab: Vocabulary):
        h, w = HIDDEN, vocab.width
        self.shapes = {"x": (HEAD + TAILS, 3 * h), "u": (h, 3 * h), "c": (h, CLASSES + TAILS), "cb": (CLASSES + TAILS,),
                       "m": (CLASSES, h, w), "mb": (CLASSES, w)}
        self.width = w
        self.size = sum(int(np.prod(s)) for s in self.shapes.values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[name] = flat[at: at + n].reshape(shape)
            at += n
        return out

    def start(self, vocab: Vocabulary) -> np.ndarray:
        """Small random weights; output biases from the counts."""
        flat = (np.random.default_rng(SEED).normal(size=self.size) * 0.1).astype(np.float32)
        p = self.views(flat)
        n = np.zeros(HEAD)
        n[vocab.member] = vocab.head_counts
        n = n.reshape(CLASSES, self.width)
        # Places without a word (fewer than HEAD kinds) get next to no mass.
        p["mb"][:] = np.log(np.maximum(n, 1e-9) / np.maximum(n.sum(1, keepdims=True), 1))
        rates = np.concatenate([n.sum(1), vocab.tail_n]) + 0.5
        p["cb"][:] = np.log(rates / rates.sum())
        return flat


def _steps(p, ids: np.ndarray, h: np.ndarray):
    """States after each step; ids: steps x lanes.  Also what the backward
    pass needs."""
    k = HIDDEN
    states, kept = np.empty((*ids.shape, k), np.float32), []
    for t in range(len(ids)):
        x, r = p["x"][ids[t]], h @ p["u"]
        gates = x[:, : 2 * k] + r[:, : 2 * k]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, reset = gates[:, :k], gates[:, k:]
        new = reset * r[:, 2 * k:]
        new += x[:, 2 * k:]
        np.tanh(new, out=new)
        kept.append((h, z, reset, new, r[:, 2 * k:]))
        h = new + z * (h - new)
        states[t] = h
    return states, kept


def _softmax(x: np.ndarray) -> np.ndarray:
    """Softmax of each row, in place; logits stay far below overflow."""
    np.exp(x, out=x)
    x *= (1 / (x @ np.ones(x.shape[1], x.dtype)))[:, None]
    return x


def _log_at(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log softmax at one place of each row; logits stay far below overflow."""
    picked = x[np.arange(len(x)), target]
    return picked - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))


def _class_of(slot: np.ndarray, tail: np.ndarray, width: int) -> np.ndarray:
    return np.where(slot >= 0, slot // width, CLASSES + tail)


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of their class, and where each head class begins and the
    last one ends."""
    small = cls.astype(np.uint16)  # numpy sorts 16-bit numbers by radix
    order = np.argsort(small, kind="stable")
    return order, np.searchsorted(small[order], np.arange(CLASSES + 1, dtype=np.uint16))


def log_probability(p, width: int, states: np.ndarray, slot: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Natural log of P(class | state), times P(member | class, state) for head
    words.  states: n x HIDDEN."""
    cls = _class_of(slot, tail, width)
    out = np.empty(len(states), np.float32)
    for a in range(0, len(states), CACHED):
        logits = states[a: a + CACHED] @ p["c"]
        logits += p["cb"]
        out[a: a + CACHED] = _log_at(logits, cls[a: a + CACHED])
    order, edges = _by_class(cls)
    order = order[: edges[-1]]
    by_class, member, inner = states[order], (slot % width)[order], np.empty(len(order), np.float32)
    for c in np.flatnonzero(np.diff(edges)):
        a, b = edges[c], edges[c + 1]
        logits = by_class[a:b] @ p["m"][c]
        logits += p["mb"][c]
        inner[a:b] = _log_at(logits, member[a:b])
    out[order] += inner
    return out


def gradient(net: Network, flat: np.ndarray, ids: np.ndarray, slot: np.ndarray, tail: np.ndarray,
             used: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Gradient of the mean negative log probability of one window; ids, slot,
    tail, used: steps x lanes (inputs, targets, which targets count)."""
    return gradient_and_state(net, flat, ids, slot, tail, used, h)[0]


def gradient_and_state(net: Network, flat: np.ndarray, ids: np.ndarray, slot: np.ndarray, tail: np.ndarray,
                       used: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``gradient``, and the state after the window."""
    p, g = net.views(flat), np.zeros(net.size, np.float32)
    d = net.views(g)
    k, n = HIDDEN, max(1, int(used.sum()))
    states, kept = _steps(p, ids, h)
    flat_states, mask = states.reshape(-1, k), used.ravel()
    s, tl = slot.ravel(), tail.ravel()
    cls = _class_of(s, tl, net.width)
    back, share = np.empty_like(flat_states), mask / np.float32(n)
    for a in range(0, len(cls), CACHED):
        own = flat_states[a: a + CACHED]
        prob = own @ p["c"]
        prob += p["cb"]
        prob = _softmax(prob)
        prob[np.arange(len(own)), cls[a: a + CACHED]] -= 1
        prob *= share[a: a + CACHED, None]
        d["c"] += own.T @ prob
        d["cb"] += np.ones(len(own), np.float32) @ prob
        back[a: a + CACHED] = prob @ p["c"].T
    order, edges = _by_class(np.where(mask, cls, CLASSES))
    order = order[: edges[-1]]
    by_class, member, place = flat_states[order], (s % net.width)[order], np.arange(len(order))
    inner, ones = np.empty_like(by_class), np.ones(len(order), np.float32)
    for c in np.flatnonzero(np.diff(edges)):
        a, b = edges[c], edges[c + 1]
        own = by_class[a:b]
        inside = own @ p["m"][c]
        inside += p["mb"][c]
        inside = _softmax(inside)
        inside[place[: b - a], member[a:b]] -= 1
        inside *= np.float32(1 / n)
        d["m"][c] = own.T @ inside
        d["mb"][c] = ones[: b - a] @ inside
        inner[a:b] = inside @ p["m"][c].T
    back[order] += inner
    back = back.reshape(states.shape)
    carry = np.zeros_like(h)
    inputs = np.empty((*ids.shape, 3 * k), np.float32)
    dr, turned = np.empty((ids.shape[1], 3 * k), np.float32), np.ascontiguousarray(p["u"].T)
    for t in range(len(ids) - 1, -1, -1):
        before, z, reset, new, rn = kept[t]
        dh, rest = back[t] + carry, 1 - z
        dnew = dh * rest * (1 - new * new)
        dz = dh * (before - new) * z * rest
        dreset = dnew * rn * reset * (1 - reset)
        dx = inputs[t]
        dx[:, :k], dx[:, k: 2 * k], dx[:, 2 * k:] = dz, dreset, dnew
        dr[:, : 2 * k], dr[:, 2 * k:] = dx[:, : 2 * k], dnew * reset
        d["u"] += before.T @ dr
        carry = dh * z + dr @ turned
    order = np.argsort(ids.ravel().astype(np.uint16), kind="stable")
    words = ids.ravel()[order]
    heads = np.flatnonzero(np.diff(words, prepend=-1))
    d["x"][words[heads]] = np.add.reduceat(inputs.reshape(-1, 3 * k)[order], heads, axis=0)
    return g, states[-1]


class Coded:
    """Coded texts of a batch: the network's input of each word (the place of a
    head word, or HEAD and the tail class), and targets."""

    def __init__(self, ids: list[bytes], start: int):
        self.at = np.concatenate([[0], np.cumsum([len(x) // 2 for x in ids])]).astype(np.int64)
        self.input = np.frombuffer(b"".join(ids), "<u2").astype(np.int64)
        self.slot, self.tail = np.where(self.input < HEAD, self.input, -1), np.maximum(self.input - HEAD, 0)
        self.start = start


def inputs_of(vocab: Vocabulary, tokens: np.ndarray) -> np.ndarray:
    slot = vocab.head_slot(tokens)
    return np.where(slot >= 0, slot, HEAD + tail_class(tokens))


def _window(coded: Coded, first: np.ndarray, lengths: np.ndarray, t0: int, steps: int):
    """Inputs, target places and which are real, for steps t0 .. of texts."""
    t = t0 + np.arange(steps)[:, None]
    real = t < lengths
    place = np.where(real, first + t, first)
    ids = np.where((t > 0) & real, coded.input[np.maximum(place - 1, 0)], coded.start)
    return ids, place, real


def lane_windows(lengths: np.ndarray, lanes: int):
    """Text and first word of each lane's next window, until all windows of all
    texts have been taken; longest texts first, so that lanes
    are full for as long as they can be."""
    queue = np.argsort(-lengths, kind="stable")
    who, queue = queue[:lanes], queue[lanes:]
    begin = np.zeros(len(who), np.int64)
    while len(who):
        yield who, begin
        begin = begin + STEPS
        done = np.flatnonzero(begin >= lengths[who])
        new = queue[: len(done)]
        queue = queue[len(done):]
        who = who.copy()
        who[done[: len(new)]], begin[done] = new, 0
        who, begin = np.delete(who, done[len(new):]), np.delete(begin, done[len(new):])


def train_texts(net: Network, weights: np.ndarray, squares: np.ndarray, coded: Coded) -> int:
    """Train ``weights`` in place on all windows of the texts; words seen."""
    lengths = np.diff(coded.at)
    state = np.zeros((len(lengths), HIDDEN), np.float32)
    seen, lanes = 0, int(min(LANES, max(16, coded.at[-1] // LANE_WORDS)))
    for who, begin in lane_windows(lengths, lanes):
        t = begin + np.arange(STEPS)[:, None]
        real = t < lengths[who]
        place = np.where(real, coded.at[who] + t, 0)
        inputs = np.where(real & (t > 0), coded.input[np.maximum(place - 1, 0)], coded.start)
        g, state[who] = gradient_and_state(net, weights, inputs, coded.slot[place], coded.tail[place], real, state[who])
        squares += g * g
        weights -= RATE * g / np.sqrt(squares)
        seen += int(real.sum())
    return seen


def train_round(texts: DataFrame, start: int, net: Network, flat: np.ndarray, squares: np.ndarray):
    """Averages of the weights and squared sums that the tasks reach, by words
    seen; None without texts."""
    held = texts.sparkSession.sparkContext.broadcast((flat, squares))

    def run(batches):
        weights, sums = (x.copy() for x in held.value)
        seen = 0
        for batch in batches:
            seen += train_texts(net, weights, sums, Coded(batch.column("ids").to_pylist(), start))
        if seen:
            vector = np.concatenate([weights.astype(np.float64) * seen, sums.astype(np.float64) * seen, [seen]])
            yield pa.RecordBatch.from_arrays([
                pa.array([0], pa.int32()), pa.array([vector.tobytes()], pa.binary())], names=["key", "value"])

    found = summed_vectors(texts.select("ids").mapInArrow(run, "key int, value binary")).collect()  # one row of fixed size
    if not found:
        return None
    total = np.frombuffer(found[0]["value"])
    mean = (total[:-1] / total[-1]).astype(np.float32)
    return mean[: net.size], mean[net.size:]


def judged(texts: DataFrame, start: int, net: Network, candidates: list[np.ndarray]) -> list[float]:
    """Sum of the log probabilities of the texts by each of the weights."""
    held = texts.sparkSession.sparkContext.broadcast(candidates)

    def run(batches):
        for batch in batches:
            coded = Coded(batch.column("ids").to_pylist(), start)
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(_score_texts(net, flat, coded).sum())]) for flat in held.value],
                names=[f"s{i}" for i in range(len(held.value))])

    names = [f"s{i}" for i in range(len(candidates))]
    sums = texts.select("ids").mapInArrow(run, ", ".join(f"{n} double" for n in names)).agg(*(F.sum(n) for n in names)).first()
    return [x or 0.0 for x in sums]


def train(texts: DataFrame, start: int, vocab: Vocabulary) -> tuple[Network, np.ndarray]:
    """``texts``: the coded training texts, with their doc_id."""
    net = Network(vocab)
    flat, squares = net.start(vocab), np.full(net.size, 1e-4, np.float32)
    judges = texts.where(F.pmod(F.xxhash64("doc_id", F.lit("judge")), F.lit(JUDGES)) == 0)
    best = None
    for i in range(ROUNDS):
        part = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == i)
        reached = train_round(part, start, net, flat, squares)
        if reached:
            *first, after = judged(judges, start, net, [reached[0]] if best is not None else [flat, reached[0]])
            best, squares = first[0] if first else best, reached[1]
            if after >= best:
                flat, best = reached[0], after
    return net, flat


def _score_texts(net: Network, flat: np.ndarray, coded: Coded) -> np.ndarray:
    """Natural log probabilities of the texts' classes and members."""
    p = net.views(flat)
    lengths = np.diff(coded.at)
    order = np.argsort(-lengths, kind="stable")
    first, sizes = coded.at[order], lengths[order]
    h = np.zeros((len(lengths), HIDDEN), np.float32)
    total = np.zeros(len(lengths))
    t0 = 0
    while len(sizes) and (live := int(np.searchsorted(-sizes, -t0))):  # texts longer than t0
        for a in range(0, live, 2048):
            b = min(a + 2048, live)
            ids, place, real = _window(coded, first[a:b], sizes[a:b], t0, STEPS)
            states, _ = _steps(p, ids, h[a:b])
            h[a:b] = states[-1]
            spots = place[real]
            found = log_probability(p, net.width, states[real], coded.slot[spots], coded.tail[spots])
            total[a:b] += np.bincount(np.nonzero(real)[1], found, b - a)
        t0 += STEPS
    out = np.zeros(len(lengths))
    out[order] = total
    return out


def coded_texts(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """row_id, doc_id, fold, ids, and what the scores have besides the network:
    n_tokens, n_known, base and fixed (sums of logs over known words), and the
    words that are not known here (rest)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    names = ["row_id", "doc_id", "fold", "ids", "n_tokens", "n_known", "base", "fixed", "rest"]
    rest_kind = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64())]))

    def run(batches):
        voc = sent.value
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        tail_log = np.log(voc.tail_n + 0.5 * (voc.tail_kinds + 1))
        for whole in batches:
            for begin in range(0, whole.num_rows, 4096):
                batch = whole.slice(begin, 4096)
                tokens, at = _tokens(utf8(batch.column("text")))
                n = len(at) - 1
                inputs = inputs_of(voc, tokens)
                c = voc.count(tokens)
                owner = np.repeat(np.arange(n), np.diff(at))
                known, is_tail = c > 0, inputs >= HEAD
                # Tail words: minus the class's denominator now, log(c + 0.5) when c is known.
                fixed = -np.bincount(owner[is_tail], tail_log[inputs[is_tail] - HEAD], n)
                both = known & is_tail
                fixed += np.bincount(owner[both], np.log(c[both] + 0.5), n)
                base = np.bincount(owner[known], np.log(c[known] + 0.5), n)
                # The others, one entry per text and word.
                key = np.stack([owner[~known], tokens[~known].view(np.int64)])
                key = key[:, np.lexsort((key[1], key[0]))]
                head = np.flatnonzero(np.any(np.diff(key, axis=1, prepend=-1) != 0, axis=0)) if key.shape[1] else np.zeros(0, int)
                entries = pa.StructArray.from_arrays([
                    pa.array(key[1, head]), pa.array(np.diff(np.append(head, key.shape[1])))], names=["hash", "n"])
                offsets = np.searchsorted(key[0, head], np.arange(n + 1))
                raw, ends = inputs.astype("<u2").tobytes(), (2 * at).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + n)), batch.column("doc_id"), batch.column("fold"),
                    pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary()), pa.array(np.diff(at)),
                    pa.array(np.bincount(owner[known], minlength=n)), pa.array(base), pa.array(fixed),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries).cast(rest_kind)], names=names)
                row += n

    return docs.mapInArrow(run, "row_id long, doc_id long, fold long, ids binary, n_tokens long, n_known long, "
                                "base double, fixed double, rest array<struct<hash:long,n:long>>")


def score(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds, F.lit(0)).cast("long")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), fold.alias("fold"))
    counts = stored(word_counts(plain.where(F.col("fold") != held)), "words")
    vocab = vocabulary(counts)
    texts = stored(coded_texts(plain, vocab), "coded")
    start = int(inputs_of(vocab, np.array([END]))[0])
    net, flat = train(texts.where(F.col("fold") != held), start, vocab)
    sent = docs.sparkSession.sparkContext.broadcast(flat)
    n_all, kinds = vocab.total, vocab.kinds

    def run(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 4096):
                batch = whole.slice(begin, 4096)
                model = _score_texts(net, sent.value, Coded(batch.column("ids").to_pylist(), start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model) if c == "ids" else batch.column(c) for c in batch.schema.names],
                    names=["model" if c == "ids" else c for c in batch.schema.names])

    kept = ["row_id", "doc_id", "fold", "ids", "n_tokens", "n_known", "base", "fixed"]
    scored = texts.select(*kept).mapInArrow(run, "row_id long, doc_id long, fold long, model double, n_tokens long, "
                                                 "n_known long, base double, fixed double")
    rare = texts.select("row_id", F.explode("rest").alias("r")).select("row_id", "r.hash", "r.n")
    found = rare.join(counts.withColumnRenamed("n", "c"), "hash", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    added = found.groupBy("row_id").agg(
        F.sum(F.col("n") * F.log(F.col("c") + 0.5)).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"))
    ln10 = float(np.log(10))
    bottom = float(np.log(n_all + 0.5 * (kinds + 1)))
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(added, "row_id", "left").select(
        "doc_id", (F.col("fold") == held).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        ((F.col("base") + more - F.col("n_tokens") * bottom) / ln10).alias("base_score"),
        ((F.col("model") + F.col("fixed") + more) / ln10).alias("score"))
