"""Personal data: rules for four kinds, and a character BiLSTM with CRF transitions that adds spans to theirs.

Rules, leftmost and non-overlapping per kind; a match that fails its check is dropped and not tried again:
email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip ``[0-9]+(\\.[0-9]+){3}``, parts at most 255;
card ``[0-9]([\\x20-]?[0-9])+`` with 16 to 19 digits that pass Luhn; phone ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 8 to 15 digits.

The tagger is trained in numpy on labelled windows: windows of documents with the rules' spans as labels, at most
``WINDOWS`` of them, the first in hash order among all documents. Characters count by class. A text is covered by windows that
overlap by half, and each character takes its scores from the window that holds it farthest from the ends. The windows that
follow each other are decoded as one sequence by Viterbi under transitions that allow no I without its B, so a span may have
any length and begin anywhere, and every span has the smallest marginal of its characters as confidence. Then a document's
spans are reconciled as a whole: equal spans count once with their best confidence, and of overlapping ones the more
confident stays. Spans under ``SURE``, or that overlap a span of the rules, are not added.
A span needs a digit or an @ to be one of the four kinds, so windows without either are run only where a span goes on
into them: else they can only decode to spans that would be dropped. Offsets are code points, ends exclusive.

Results for special rows: a null text is empty; repeated rows and rows without doc_id are scanned each; without any
labelled window there is no tagger and the rules' spans are all. Other columns of the input are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import in_steps, small_batches, text_or_empty

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE = 64, 32
WINDOWS = 1200
HIDDEN, EMBED, STEPS, BATCH, RATE = 12, 8, 240, 32, 0.03
SURE = 0.9
DECODED = 1 << 16  # characters that are decoded side by side; a longer stretch is decoded alone

_TRIGGER = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")


def _emails(text: str):
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            yield begin, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    doubled = (int(d) * 2 if k % 2 else int(d) for k, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, begin, end) by kind, then begin."""
    if not _TRIGGER.search(text):
        return []
    found = [(0, *span) for span in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c in string.digits for c in m[0]) <= 15]
    return found


# --- characters, tags and windows

_MARKS = "@.-+()_%:/,=\"'#*!?|&$;<>[]"
N_CLASSES = 8 + len(_MARKS)
N_TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind


@functools.cache
def _classes() -> np.ndarray:
    """Class of each ASCII code point; beyond ASCII are letters of class 6."""
    out = np.full(129, 7, np.uint8)
    for chars, kind in ((string.digits, 1), (string.ascii_lowercase, 2), (string.ascii_uppercase, 3), (" ", 4), ("\n\t\r", 5)):
        out[[ord(c) for c in chars]] = kind
    out[[ord(c) for c in _MARKS]] = np.arange(8, N_CLASSES)
    out[128] = 6
    return out


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _classes()[np.minimum(points, 128)]


def all_starts(n: int) -> np.ndarray:
    """Starts of all windows of a text of ``n`` characters; the last one ends with the text."""
    return np.unique([*range(0, max(1, n - WIDTH), STRIDE), max(0, n - WIDTH)] if n > WIDTH else [0])


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @; the last ones end with the text."""
    hits = np.array([m.start() for m in _TRIGGER.finditer(text)])
    if not len(hits):
        return []
    starts = all_starts(len(text))
    return starts[np.searchsorted(hits, starts) < np.searchsorted(hits, starts + WIDTH)].tolist()


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(length, np.uint8)
    for kind, begin, end in spans:
        if not out[begin:end].any():
            out[begin:end] = 2 + 2 * kind
            out[begin] = 1 + 2 * kind
    return out


def _padded(codes: np.ndarray, start: int) -> np.ndarray:
    part = codes[start : start + WIDTH]
    return np.pad(part, (0, WIDTH - len(part)))  # class 0 is padding


# --- the model

def _barriers() -> tuple[np.ndarray, np.ndarray]:
    """-1e4 where no tag may begin a window, or follow another."""
    first, follow = np.zeros(N_TAGS, np.float32), np.zeros((N_TAGS, N_TAGS), np.float32)
    for kind in range(len(KINDS)):
        inner = 2 + 2 * kind
        follow[:, inner] = -1e4
        follow[[inner - 1, inner], inner] = 0
    return first, follow  # a window may begin inside a span


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """BiLSTM emissions and a linear-chain CRF over them; all arrays are float32 and all batches of equal length."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        normal = lambda *shape: (draw.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {"embed": normal(N_CLASSES, EMBED), "out": normal(2 * HIDDEN, N_TAGS), "bias": np.zeros(N_TAGS, np.float32), "first": np.zeros(N_TAGS, np.float32), "follow": np.zeros((N_TAGS, N_TAGS), np.float32)}
        for side in "lr":
            self.p |= {f"x{side}": normal(EMBED, 4 * HIDDEN), f"h{side}": normal(HIDDEN, 4 * HIDDEN), f"b{side}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"b{side}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def _run(self, codes: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (time, batch, HIDDEN) of one direction, in its own order of time."""
        table = self.p["embed"] @ self.p[f"x{side}"] + self.p[f"b{side}"]
        n = codes.shape[1]
        h = c = np.zeros((n, HIDDEN), np.float32)
        states, kept = [], []
        for row in codes:
            z = table[row] + h @ self.p[f"h{side}"]
            gates = 0.5 + 0.5 * np.tanh(0.5 * z[:, : 3 * HIDDEN])
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            t = np.tanh(c)
            if keep:
                kept.append((row, h, before, i, f, o, g, t))
            h = o * t
            states.append(h)
        return np.stack(states), kept

    def emissions(self, codes: np.ndarray, keep: bool = False):
        """(time, batch, tags) scores for codes (time, batch)."""
        left, a = self._run(codes, "l", keep)
        right, b = self._run(codes[::-1], "r", keep)
        both = np.concatenate([left, right[::-1]], axis=2)
        return both @ self.p["out"] + self.p["bias"], both, (a, b)

    def _chain(self) -> tuple[np.ndarray, np.ndarray]:
        first, follow = _barriers()
        return self.p["first"] + first, self.p["follow"] + follow

    def marginals(self, scores: np.ndarray, live: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tag marginals (time, batch, tags), expected transitions (tags, tags) and log partition.

        At step t only the first ``live[t]`` sequences go on (None: all); what follows the end of one means nothing.
        """
        first, follow = self._chain()
        live = live or [scores.shape[1]] * len(scores)
        ahead = [first + scores[0]]
        for s, n in zip(scores[1:], live[1:]):
            ahead.append(np.concatenate([_sum_exp(ahead[-1][:n, :, None] + follow, 1) + s[:n], ahead[-1][n:]]))
        total = _sum_exp(ahead[-1], 1)
        behind = [np.zeros_like(ahead[-1])]
        for s, n in zip(scores[:0:-1], live[:0:-1]):
            behind.append(np.concatenate([_sum_exp(follow + (s[:n] + behind[-1][:n])[:, None, :], 2), behind[-1][n:]]))
        behind.reverse()
        single = np.exp(np.stack(ahead) + np.stack(behind) - total[None, :, None])
        pairs = np.zeros_like(follow)
        for t in range(1, len(scores)):
            n = live[t]
            joint = ahead[t - 1][:n, :, None] + follow + (scores[t] + behind[t])[:n, None, :] - total[:n, None, None]
            pairs += np.exp(joint).sum(axis=0)
        return single, pairs, total

    def decode(self, scores: np.ndarray, live: list[int] | None = None) -> np.ndarray:
        """Best tags (time, batch); ``live`` as for the marginals, beyond the end of a sequence its last tag is repeated."""
        first, follow = self._chain()
        live = live or [scores.shape[1]] * len(scores)
        best, back = first + scores[0], []
        for s, n in zip(scores[1:], live[1:]):
            ways = best[:n, :, None] + follow
            choice = np.tile(np.arange(N_TAGS, dtype=np.uint8), (len(best), 1))
            choice[:n] = ways.argmax(axis=1)
            back.append(choice)
            best = np.concatenate([ways.max(axis=1) + s[:n], best[n:]])
        path = [best.argmax(axis=1)]
        for choice in reversed(back):
            path.append(np.take_along_axis(choice, path[-1][:, None], 1)[:, 0])
        return np.stack(path[::-1])

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of a batch (time, batch) and its slope."""
        scores, both, kept = self.emissions(codes, keep=True)
        single, pairs, total = self.marginals(scores)
        first, follow = self._chain()
        n, rows = codes.shape[1], np.arange(codes.shape[1])
        gold = first[tags[0]] + scores[0, rows, tags[0]]
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        wrong = single.copy()
        wrong[0, rows, tags[0]] -= 1
        for t in range(1, len(tags)):
            gold = gold + follow[tags[t - 1], tags[t]] + scores[t, rows, tags[t]]
            wrong[t, rows, tags[t]] -= 1
            np.add.at(pairs, (tags[t - 1], tags[t]), -1)
        wrong = (wrong / n).astype(np.float32)
        grad["first"] += wrong[0].sum(axis=0)
        grad["follow"] += pairs / n
        grad["out"] += np.einsum("tnh,tnk->hk", both, wrong)
        grad["bias"] += wrong.sum(axis=(0, 1))
        hidden = wrong @ self.p["out"].T
        for side, steps, slope in (("l", kept[0], hidden[:, :, :HIDDEN]), ("r", kept[1], hidden[::-1, :, HIDDEN:])):
            dh = dc = np.zeros((n, HIDDEN), np.float32)
            per_class = np.zeros((N_CLASSES, 4 * HIDDEN), np.float32)
            for (row, h, before, i, f, o, g, t), from_above in zip(reversed(steps), slope[::-1]):
                dh = dh + from_above
                dc = dc + dh * o * (1 - t * t)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * t * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                grad[f"h{side}"] += h.T @ dz
                np.add.at(per_class, row, dz)
                dh, dc = dz @ self.p[f"h{side}"].T, dc * f
            grad[f"x{side}"] += self.p["embed"].T @ per_class
            grad[f"b{side}"] += per_class.sum(axis=0)
            grad["embed"] += per_class @ self.p[f"x{side}"].T
        return float((total - gold).mean()), grad

    def train(self, codes: np.ndarray, tags: np.ndarray, steps: int = STEPS) -> list[float]:
        """Adam over shuffled batches of windows (windows, time); returns the loss of each step."""
        draw = np.random.default_rng(11)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        order, history = np.empty(0, int), []
        for step in range(1, steps + 1):
            while len(order) < min(BATCH, len(codes)):
                order = np.append(order, draw.permutation(len(codes)))
            part, order = order[:BATCH], order[BATCH:]
            loss, grad = self.gradient(codes[part].T, tags[part].T)
            history.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            rate = RATE * min(1.0, 1.25 * (1 - (step - 1) / steps))
            for name, g in grad.items():
                g = g * min(1.0, 5 / (norm + 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                self.p[name] = (self.p[name] - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return history


def reconcile(found: list[tuple[float, int, int, int]], rules: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (kind, begin, end) of a document that are added to the rules' ones, from (confidence, kind, begin, end)."""
    best: dict[tuple[int, int, int], float] = {}
    for sure, *span in found:
        if sure >= SURE:
            best[tuple(span)] = max(sure, best.get(tuple(span), 0.0))
    taken, added = [(b, e) for _, b, e in rules], []
    for (kind, begin, end), _ in sorted(best.items(), key=lambda x: (-x[1], x[0][1] - x[0][2], x[0])):
        if all(end <= b or e <= begin for b, e in taken):
            added.append((kind, begin, end))
            taken.append((begin, end))
    return added


def _decoded(model: Tagger, parts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Best tags of each sequence of scores (time, tags), and their marginals if there is a span."""
    out: list = [None] * len(parts)
    order = sorted(range(len(parts)), key=lambda k: -len(parts[k]))
    while order:
        longest = len(parts[order[0]])
        group, order = order[: max(1, DECODED // longest)], order[max(1, DECODED // longest) :]
        lengths = np.array([len(parts[k]) for k in group])
        scores = np.zeros((longest, len(group), N_TAGS), np.float32)
        for column, k in enumerate(group):
            scores[: len(parts[k]), column] = parts[k]
        live = np.searchsorted(-lengths, -np.arange(longest)).tolist()  # sequences longer than t
        tags = model.decode(scores, live)
        busy = np.flatnonzero(tags.any(axis=0))
        chance = np.zeros(tags.shape, np.float32)
        if len(busy):
            some = np.searchsorted(-lengths[busy], -np.arange(longest)).tolist()
            until = lengths[busy[0]]
            single = model.marginals(scores[:until, busy], some[:until])[0]
            chance[:until, busy] = np.take_along_axis(single, tags[:until, busy][:, :, None].astype(int), 2)[:, :, 0]
        for column, k in enumerate(group):
            out[k] = tags[: lengths[column], column], chance[: lengths[column], column]
    return out


def _stretches(size: int, starts: np.ndarray, run: dict[int, np.ndarray]) -> list[tuple[int, int, int, np.ndarray]]:
    """(first window, last window, begin, scores) of the windows in ``run`` that follow each other."""
    out, at = [], sorted(run)
    low = 0
    for k in range(1, len(at) + 1):
        if k < len(at) and at[k] == at[k - 1] + 1:
            continue
        some = at[low:k]
        # two windows meet in the middle of what they share
        cuts = [starts[some[0]], *((starts[i] + WIDTH + starts[j]) // 2 for i, j in zip(some, some[1:])), min(starts[some[-1]] + WIDTH, size)]
        scores = np.concatenate([run[i][b - starts[i] : e - starts[i]] for i, b, e in zip(some, cuts, cuts[1:])])
        out.append((some[0], some[-1], int(cuts[0]), scores))
        low = k
    return out


def _spans_in_step(model: Tagger, texts: list[str]) -> list[list[tuple[float, int, int, int]]]:
    found: list[list] = [[] for _ in texts]
    codes, starts, run, wanted = {}, {}, {}, []
    for k, text in enumerate(texts):
        if some := window_starts(text):
            codes[k], starts[k], run[k] = encode(text), all_starts(len(text)), {}
            wanted += [(k, i) for i in np.searchsorted(starts[k], some).tolist()]
    more = 1
    while wanted:
        for low in range(0, len(wanted), 256):
            part = wanted[low : low + 256]
            scores = model.emissions(np.stack([_padded(codes[k], starts[k][i]) for k, i in part], axis=1))[0]
            for column, (k, i) in enumerate(part):
                run[k][i] = scores[:, column]
        changed = sorted({k for k, _ in wanted})
        places = [(k, *s) for k in changed for s in _stretches(len(texts[k]), starts[k], run[k])]
        further: set[tuple[int, int]] = set()
        for k in changed:
            found[k] = []
        for (k, first, last, begin, _), (path, chance) in zip(places, _decoded(model, [p[-1] for p in places])):
            if path[0]:  # a span may have begun before; twice as many windows each time, so that none is decoded often
                further |= {(k, i) for i in range(max(0, first - more), first)}
            if path[-1]:
                further |= {(k, i) for i in range(last + 1, min(last + 1 + more, len(starts[k])))}
            for b in np.flatnonzero(path % 2).tolist():
                e = b + 1
                while e < len(path) and path[e] == path[b] + 1:
                    e += 1
                if _TRIGGER.search(texts[k], begin + b, begin + e):
                    found[k].append((float(chance[b:e].min()), int(path[b] - 1) // 2, begin + b, begin + e))
        wanted = sorted((k, i) for k, i in further if i not in run[k])
        more *= 2
    return found


def tagger_spans(model: Tagger, texts: list[str]) -> list[list[tuple[float, int, int, int]]]:
    """(confidence, kind, begin, end) of the spans of each text, whatever their length and place."""
    return [spans for low, high in in_steps(texts) for spans in _spans_in_step(model, texts[low:high])]


# --- Spark

def labelled_windows(docs: DataFrame) -> DataFrame:
    """(codes, tags) of every window with a digit or an @, labelled by the rules."""

    def work(batches):
        for batch in batches:
            codes, tags = [], []
            for text in batch.column(0).to_pylist():
                if starts := window_starts(text):
                    marked, chars = tags_of(len(text), rule_spans(text)), encode(text)
                    codes += [_padded(chars, s).tobytes() for s in starts]
                    tags += [_padded(marked, s).tobytes() for s in starts]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()), pa.array(tags, pa.binary())], names=["codes", "tags"])

    wanted = docs.select(text_or_empty().alias("text")).where(F.col("text").rlike("[0-9@]"))
    return wanted.mapInArrow(work, "codes binary, tags binary")


def fit(docs: DataFrame) -> Tagger | None:
    """The tagger, trained on at most ``WINDOWS`` windows of fixed length; None if there are none."""
    small_batches(docs.sparkSession)
    windows = labelled_windows(docs).distinct().orderBy(F.xxhash64("codes", "tags"), "codes", "tags").limit(WINDOWS).toArrow()
    if not len(windows):
        return None
    codes, tags = (np.frombuffer(b"".join(windows.column(c).to_pylist()), np.uint8).reshape(-1, WIDTH) for c in ("codes", "tags"))
    model = Tagger()
    model.train(codes, tags.astype(int))
    return model


def _scanned(docs: DataFrame, schema: str, cells, columns: list) -> DataFrame:
    """``cells(batch, texts, rules, added)`` gives the arrays of the output for a batch whose column 0 is the text."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def work(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rules = [rule_spans(t) for t in texts]
            found = tagger_spans(model, texts) if model else [[] for _ in texts]
            added = [reconcile(f, r) for f, r in zip(found, rules)]
            arrays = cells(batch, texts, rules, added)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return docs.select(text_or_empty().alias("text"), *columns).mapInArrow(work, schema)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for kind, begin, end in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """Counts and digest of the rules' spans, and all spans, for each row of ``docs`` (doc_id, text)."""
    def cells(batch, texts, rules, added):
        counts = {f"n_{name}": pa.array([sum(s[0] == k for s in r) for r in rules], pa.int64()) for k, name in enumerate(KINDS)}
        return {
            "doc_id": batch.column(1), **counts, "base_sha256": pa.array([hashlib.sha256(_written(r).encode()).hexdigest() for r in rules], pa.string()),
            "spans": pa.array([_written(r + a) for r, a in zip(rules, added)], pa.string()), "n_added": pa.array([len(a) for a in added], pa.int64()),
        }

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return _scanned(docs, schema, cells, [F.col("doc_id").cast("bigint").alias("doc_id")])


def masked_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every stretch of spans replaced by the name of the kind that begins it."""
    out, at = [], 0
    for begin, kind, end in sorted((b, k, e) for k, b, e in spans):
        if begin >= at:
            out += [text[at:begin], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """The columns of documents with all spans masked; n_chars follows the text, a null text stays null."""
    def cells(batch, texts, rules, added):
        done = [masked_text(t, r + a) for t, r, a in zip(texts, rules, added)]
        none = batch.column(5).to_pylist()
        return {
            "doc_id": batch.column(1), "text": pa.array([None if n else t for n, t in zip(none, done)], pa.string()), "lang": batch.column(2), "source": batch.column(3),
            "n_chars": pa.array([old if n or t == was else len(t) for n, t, was, old in zip(none, done, texts, batch.column(4).to_pylist())], pa.int64()),
        }

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"), F.col("text").isNull().alias("none")]
    return _scanned(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint", cells, columns)
