"""Operator 8: personal data by a character-level bidirectional LSTM with a CRF.

Rules find the base spans exactly. The tagger adds spans that they miss (phone numbers
without a plus sign, numbers that fail a check digit, obfuscated addresses). It is trained
in numpy on the driver, on windows of at most CARRIERS documents with their rule spans and
with generated, labelled spans put in. In tasks, each whole text is cut into overlapping
windows, all of which the network reads, many at a time; their tag scores are averaged
where they overlap, and the best tags of the whole text reconcile them.

The best path over a text need not be searched step by step: where "outside" leads the
other tags by more than transitions can win back, every best path is outside, and the text
falls into parts that are decoded on their own, with the same result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, text_of

#: The kinds, in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: Tags: 0 outside, then beginning and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: The most documents whose text the tagger is trained on, and the windows made of them.
CARRIERS, WINDOWS = 200, 1000
#: Characters of a window in training and in use, and how far the latter are apart.
WIDTH, WINDOW, STRIDE = 96, 256, 236
HIDDEN, EPOCHS, BATCH = 12, 16, 32
#: Windows that go through the network together, and characters of text that are tagged together.
TOGETHER, CHARACTERS = 1536, 1 << 18
#: The exp of gates is that of 1 / 2 ** SQUARINGS, squared that often, where it is taken of no more than LARGEST.
SQUARINGS, LARGEST = 5, 64
#: Parts that are decoded together, so that what a step holds does not grow with a text.
PARTS = 1 << 14
#: Codes: ASCII as it is, any other character, and padding.
OTHER, PAD = 128, 129
SEED = 8

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile("[0-9@]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As a search for local part, "@" and domain would find them, in time proportional to the text: from each "@" outwards."""
    free = 0
    at = text.find("@")
    while at >= 0:
        if at >= free:
            s = at
            while s > free and text[s - 1] in _LOCAL:
                s -= 1
            if s < at and (m := _DOMAIN.match(text, at + 1)):
                yield s, m.end()
                free = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of kind, end) in code points, by start, then kind; leftmost without overlap within a kind."""
    if not _TRIGGER.search(text):
        return []
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


def codes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(c < 128, c, OTHER).astype(np.int16)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Tagger:
    """Parameters: g, u input table and recurrent weights of each direction; w, b tag scores; a transitions, s first tag."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new(rng: np.random.Generator) -> Tagger:
        p = {f"{k}{d}": rng.normal(0, 0.15, (n, 4 * HIDDEN)).astype(np.float32) for d in "fb" for k, n in (("g", PAD + 1), ("u", HIDDEN))}
        for d in "fb":
            p["g" + d][:, HIDDEN : 2 * HIDDEN] += 1  # forget gates start open
        p |= {"w": rng.normal(0, 0.15, (2 * HIDDEN, TAGS)).astype(np.float32), "b": np.zeros(TAGS, np.float32), "a": np.zeros((TAGS, TAGS), np.float32), "s": np.zeros(TAGS, np.float32)}
        return Tagger(p)

    def _lstm(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x: codes (windows, width), in reading order of the direction. Hidden states in the same order."""
        n, width = x.shape
        g, u, k = self.p["g" + d], self.p["u" + d], HIDDEN
        h, c, out = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32), np.empty((n, width, k), np.float32)
        for t in range(width):
            z = g[x[:, t]] + h @ u
            gates, new = _sigmoid(z[:, : 3 * k]), np.tanh(z[:, 3 * k :])
            before, was = c, h
            c = gates[:, k : 2 * k] * c + gates[:, :k] * new
            h = gates[:, 2 * k :] * np.tanh(c)
            out[:, t] = h
            if keep is not None:
                keep.append((gates, new, before, c, was))
        return out

    def hidden(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kf, kb = (keep.setdefault(d, []) for d in "fb") if keep is not None else (None, None)
        return np.concatenate([self._lstm(x, "f", kf), self._lstm(x[:, ::-1], "b", kb)[:, ::-1]], axis=2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.p["w"] + self.p["b"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tags y for codes x, and its gradients."""
        p, keep = self.p, {}
        hid = self.hidden(x, keep)
        e = (hid @ p["w"] + p["b"]).astype(np.float64)
        n, width = x.shape
        a = p["a"].astype(np.float64)
        low = lambda z, axis: (m := z.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(z - m).sum(axis))
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + p["s"]
        for t in range(1, width):
            alpha[:, t] = low(alpha[:, t - 1, :, None] + a, 1) + e[:, t]
        for t in range(width - 2, -1, -1):
            beta[:, t] = low(a + (e[:, t + 1] + beta[:, t + 1])[:, None], 2)
        z = low(alpha[:, -1], 1)
        de = np.exp(alpha + beta - z[:, None, None])
        pair = np.exp(alpha[:, :-1, :, None] + a + (e[:, 1:] + beta[:, 1:])[:, :, None] - z[:, None, None, None])
        rows, cols = np.arange(n)[:, None], np.arange(width)
        gold = e[rows, cols, y].sum(1) + p["s"][y[:, 0]] + a[y[:, :-1], y[:, 1:]].sum(1)
        de[rows, cols, y] -= 1
        de /= n
        da = pair.sum((0, 1))
        np.subtract.at(da, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        out = {"a": da / n, "s": de[:, 0].sum(0), "b": de.sum((0, 1)), "w": hid.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)}
        dh = de @ p["w"].T
        for d, part, xs in (("f", dh[:, :, :HIDDEN], x), ("b", dh[:, ::-1, HIDDEN:], x[:, ::-1])):
            out["g" + d], out["u" + d] = self._back(xs, part, keep[d], d)
        return float((z - gold).mean()), out

    def _back(self, x: np.ndarray, dh: np.ndarray, keep: list, d: str) -> tuple[np.ndarray, np.ndarray]:
        u, k = self.p["u" + d], HIDDEN
        gates, new, before, c, was = (np.stack(z) for z in zip(*keep))  # (width, windows, ...)
        i, f, o, tc = gates[:, :, :k], gates[:, :, k : 2 * k], gates[:, :, 2 * k :], np.tanh(c)
        to_c, to_z = o * (1 - tc**2), np.stack([new * i * (1 - i), before * f * (1 - f), tc * o * (1 - o), i * (1 - new**2)], 2)
        every = np.empty((len(c), len(x), 4, k), np.float32)
        dh = np.ascontiguousarray(dh.transpose(1, 0, 2), np.float32)
        h_next, c_next, back = np.zeros_like(dh[0]), np.zeros_like(dh[0]), np.ascontiguousarray(u.T)
        for t in range(len(c) - 1, -1, -1):
            h = dh[t] + h_next
            cc = h * to_c[t] + c_next
            np.multiply(to_z[t], cc[:, None], out=every[t])
            np.multiply(to_z[t, :, 2], h, out=every[t, :, 2])
            h_next, c_next = every[t].reshape(-1, 4 * k) @ back, cc * f[t]
        every = every.reshape(-1, 4 * k)
        seen = (x.T.reshape(-1, 1) == np.arange(PAD + 1)).astype(np.float32)
        return seen.T @ every, was.reshape(-1, k).T @ every

    def viterbi(self, e: np.ndarray, after: bool = False, before: bool = False) -> np.ndarray:
        """The best tags for scores e (length, TAGS); after, before: outside stands before the first, after the last."""
        return self.best_paths(e, np.array([0]), np.array([len(e)]), np.array([after]), np.array([before]))

    def best_paths(self, e: np.ndarray, starts: np.ndarray, ends: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The best tags of the parts starts:ends of scores e (length, TAGS), each on its own, and outside elsewhere; all parts take a step at once."""
        a, out = self.p["a"], np.zeros(len(e), np.int8)
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that the parts that go on are the first ones
        starts, ends, after, before = starts[order], ends[order], after[order], before[order]
        going = np.searchsorted(starts - ends, -np.arange(ends[0] - starts[0] if len(starts) else 0), side="left")
        best = e[starts] + np.where(after[:, None], a[0], self.p["s"])
        back = []
        for t, m in enumerate(going[1:], 1):
            z = best[:m, None] + a.T
            back.append(z.argmax(2).astype(np.int8))
            best[:m] = z.max(2) + e[starts[:m] + t]
        y = (best + np.where(before[:, None], a[:, 0], 0)).argmax(1)
        out[ends - 1] = y
        for t in range(len(going) - 1, 0, -1):
            m = going[t]
            y[:m] = back[t - 1][np.arange(m), y[:m]]
            out[starts[:m] + t - 1] = y[:m]
        return out

    def gate_tables(self, d: str, squarings: int) -> tuple[np.ndarray, np.ndarray]:
        """g and u of direction d by gate, (4, codes or HIDDEN, HIDDEN), for window_scores(): they give v = (1 - z / 2 ** squarings) / 2, of 2 * z for the new values, from half of the hidden state."""
        by = np.array([1, 1, 1, 2], np.float32)[:, None, None] / (2 << squarings)
        g, u = (self.p[k + d].reshape(-1, 4, HIDDEN).transpose(1, 0, 2) * by for k in "gu")
        return np.ascontiguousarray(0.5 - g, np.float32), np.ascontiguousarray(-2 * u, np.float32)

    def window_scores(self, x: np.ndarray) -> np.ndarray:
        """scores() of windows (n, width) as (TAGS, width, n).

        sigmoid(z) is 1 / (1 + exp(-z)) and tanh(z) is 2 * sigmoid(2 * z) - 1, so all gates take one exp. In NumPy that costs as much as a
        dozen products, so it comes from exp(y) with y = -z / 2 ** SQUARINGS, squared that often: with v = (1 + y) / 2, 2 / 3 * ((v * v + 3 / 4) ** 2 + v) is
        1 + y + y ** 2 / 2 + y ** 3 / 6 + y ** 4 / 24. Gates differ by less than 1e-5 from those of exp where z is below LARGEST; weights that allow more go by exp.
        """
        k, n, m = HIDDEN, len(x), 1 << SQUARINGS
        x = np.ascontiguousarray(x.T, np.intp)
        v, z, h, c, score = (np.empty(s, np.float32) for s in ((4, n, k), (4, n, k), (n, k), (n, k), (TAGS, n)))
        i, f, o, new = z
        out = np.empty((len(x), TAGS, n), np.float32)
        with np.errstate(over="ignore"):  # what stands for exp may be infinite, and its gate then 0
            for d, w, codes_, to in (("f", self.p["w"][:k], x, out), ("b", self.p["w"][k:], x[::-1], out[::-1])):
                g, u = self.gate_tables(d, SQUARINGS)
                exact = m * (2 * np.abs(g - 0.5).max(1) + np.abs(u).sum(1)).max() > LARGEST
                one = np.float32(1 if exact else 1.5**m)
                over = np.array([1, 1, 1, -4], np.float32)[:, None, None] * one  # -2 * c is kept in place of c
                w = np.ascontiguousarray(2 * w.T)
                c[:] = h[:] = 0  # h is half of the hidden state
                for row, scores in zip(codes_, to):
                    np.matmul(h, u, out=v)
                    np.take(g, row, axis=1, out=z, mode="clip")
                    v += z
                    if exact:
                        np.multiply(v, 2 * m, out=z)
                        z -= m
                        np.exp(z, out=z)
                    else:
                        np.multiply(v, v, out=z)
                        z += 0.75
                        z *= z
                        z += v
                        for _ in range(SQUARINGS):
                            z *= z
                    z += one
                    np.divide(over, z, out=z)
                    new += 2
                    new *= i
                    c *= f
                    c += new
                    np.exp(c, out=h)
                    h += 1
                    np.divide(1, h, out=h)
                    h -= 0.5
                    h *= o
                    if d == "f":
                        np.matmul(w, h.T, out=scores)
                        scores += self.p["b"][:, None]
                    else:
                        scores += np.matmul(w, h.T, out=score)
        return out.transpose(1, 0, 2)

    def may_hold(self, e: np.ndarray) -> np.ndarray:
        """led() of the leads of outside in scores e (length, TAGS) of a text."""
        return self.led(e[:, 0] - e[:, 1:].max(1))

    def led(self, lead: np.ndarray) -> np.ndarray:
        """For the lead of outside at each place of a text, its score less the best of the other tags: where its best tags may be anything but outside.

        A stretch of other tags beats outside only if what its transitions win, entering and
        leaving once and going on at each place but one, is worth what its scores lose. A
        place may be in such a stretch if the best stretch around it could win, by sums of
        gains up to it and from it on.
        """
        a, s = self.p["a"].astype(np.float64), self.p["s"].astype(np.float64)
        on = (a[1:, 1:] - a[0, 0]).max()
        once = max((a[0, 1:] - a[0, 0]).max(), (s[1:] - s[0]).max()) + max((a[1:, 0] - a[0, 0]).max(), 0.0) - on
        gain = on - lead.astype(np.float64)

        def up_to(gain: np.ndarray) -> np.ndarray:
            sums = np.cumsum(gain)
            return sums - np.minimum.accumulate(np.concatenate([[0.0], sums[:-1]]))

        return once + up_to(gain) + up_to(gain[::-1])[::-1] - gain >= -1e-6

    def tag(self, texts: list[np.ndarray]) -> list[list[tuple[int, np.ndarray]]]:
        """For texts as codes: (start, tags) of parts, outside of which, and perhaps in which, all is outside; the best tags of each whole text, with averaged scores of its overlapping windows."""
        size = np.array([len(c) for c in texts], np.int64)
        windows = np.maximum(0, -(-(size - WINDOW) // STRIDE)) + 1
        of, last = np.repeat(np.arange(len(texts)), windows), np.cumsum(windows) - 1
        offset = (np.arange(len(of)) - (last - windows + 1)[of]) * STRIDE
        laid = np.full(int(size.sum()) + WINDOW, PAD, np.int16)
        if len(texts):
            laid[: size.sum()] = np.concatenate(texts)
        begins = np.cumsum(size) - size
        sums = np.empty((WINDOW, TAGS, len(of)), np.float32).transpose(1, 0, 2)
        for part in np.array_split(np.arange(len(of)), -(-len(of) // TOGETHER)) if len(of) else ():
            x = laid[(begins[of] + offset)[part, None] + np.arange(WINDOW)]
            for w in part[(offset[part] + WINDOW > size[of[part]])] - part[0]:
                x[w, size[of[part[w]]] - offset[part[w]] :] = PAD
            sums[:, :, part[0] : part[-1] + 1] = self.window_scores(x)
        # the first places of a window, but for a text's first one, are read by the window before as well
        later = np.flatnonzero(offset)
        sums[:, : WINDOW - STRIDE, later] = (sums[:, STRIDE:, later - 1] + sums[:, : WINDOW - STRIDE, later]) / 2
        by_window = np.ascontiguousarray((sums[0] - sums[1:].max(0)).T)
        open_ = np.zeros(len(laid) + 1, bool)  # whether a place may hold anything but outside; one more, which ends the last part
        first = np.zeros(len(laid) + 1, bool)
        first[begins] = first[begins + size] = True
        for at, n, low, high in zip(begins, size, last - windows + 1, last):
            if n:
                lead = np.concatenate([by_window[low:high, :STRIDE].ravel(), by_window[high]])[:n]
                open_[at : at + n] = self.led(lead)
        # a part begins where a text does or after a closed place, and ends likewise
        was = np.concatenate([[False], open_[:-1]])
        starts, ends = np.flatnonzero(open_ & (first | ~was)), np.flatnonzero(was & (first | ~open_))
        who = np.searchsorted(begins + size, starts, side="right")
        out = [[] for _ in texts]
        for low in range(0, len(starts), PARTS):
            ss, ends_, k = starts[low : low + PARTS], ends[low : low + PARTS], who[low : low + PARTS]
            to = np.cumsum(ends_ - ss)
            at = to - (ends_ - ss)  # where each part's places are in what follows
            place = np.arange(to[-1]) + np.repeat(ss - begins[k] - at, ends_ - ss)
            window = np.minimum(place // STRIDE, np.repeat(windows[k], ends_ - ss) - 1)
            e = sums[:, place - window * STRIDE, window + np.repeat(last[k] - windows[k] + 1, ends_ - ss)]
            y = self.best_paths(np.ascontiguousarray(e.T), at, to, ~first[ss], ~first[ends_])
            for i in np.flatnonzero(np.add.reduceat(y != 0, at)):
                out[k[i]].append((int(ss[i] - begins[k[i]]), y[at[i] : to[i]]))
        return out


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    y = np.zeros(length, np.int64)
    for s, k, e in sorted(spans, reverse=True):  # earlier spans win
        y[s:e] = 2 + 2 * k
        y[s] = 1 + 2 * k
    return y


def generated(rng: np.random.Generator) -> tuple[str, int]:
    """A made-up span and its kind, in the usual spellings and in some that the rules miss."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9)))
    pick = lambda *x: x[rng.integers(len(x))]
    kind = int(rng.integers(4))
    if kind == 0:
        at, dot = pick(("@", "."), ("@", "."), ("@", "."), (" @ ", "."), ("[@]", "."), ("@", " dot "), (" [at] ", "."), (" at ", " dot "))
        return f"{word()}{pick('', '.', '_', '-')}{pick(word(), digits(2))}{at}{word()}{pick('', digits(1))}{dot}{pick('com', 'org', 'net', word())}", kind
    if kind == 1:
        return pick(".", ".", ".", " . ").join(str(x) for x in rng.integers(0, 256, 4)), kind
    if kind == 2:
        sep = pick("", "", " ", "-", ".")
        return sep.join(digits(4) for _ in range(4)), kind
    return pick("+{a} ({b}) {c}-{d}", "+{a} ({b}) {c}-{d}", "+{a}-{b}-{c}-{d}", "({b}) {c}-{d}", "{b}-{c}-{d}", "00{a} {b} {c} {d}").format(a=digits(int(rng.integers(1, 3))), b=digits(3), c=digits(3), d=digits(4)), kind


def examples(texts: list[str], count: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Windows (codes, tags) of the texts: some as they are, with rule spans; some with a plain number, most with a generated span put in."""
    xs, ys = np.full((count, WIDTH), PAD, np.int16), np.zeros((count, WIDTH), np.int64)
    for r in range(count):
        text = texts[rng.integers(len(texts))] if texts else ""
        at = int(rng.integers(max(1, len(text) - WIDTH + 1)))
        text = text[at : at + WIDTH]
        if r % 5 == 0:
            spans = base_spans(text)
        elif r % 5 == 1:  # numbers that are nobody's
            plain, put = "".join(map(str, rng.integers(0, 10, rng.integers(1, 8)))), int(rng.integers(max(1, len(text))))
            text, spans = f"{text[:put]} {plain} {text[put:]}"[:WIDTH], []
        else:
            (span, kind), put = generated(rng), int(rng.integers(max(1, min(len(text), WIDTH - 40))))
            before = _TRIGGER.sub("x", text[:put])
            text = f"{before} {span} {_TRIGGER.sub('x', text[put:])}"[:WIDTH]
            spans = [(len(before) + 1, kind, min(WIDTH, len(before) + 1 + len(span)))]
        xs[r, : len(text)] = codes(text)
        ys[r, : len(text)] = tags_of(len(text), [s for s in spans if s[2] <= len(text)])
    return xs, ys


def fit(texts: list[str], windows: int = WINDOWS, epochs: int = EPOCHS, seed: int = SEED) -> Tagger:
    """Adam on the CRF's likelihood; the same texts give the same tagger."""
    rng = np.random.default_rng(seed)
    x, y = examples(texts, windows, rng)
    tagger = Tagger.new(rng)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(windows)
        for low in range(0, windows, BATCH):
            step += 1
            i = order[low : low + BATCH]
            _, grads = tagger.gradients(x[i], y[i])
            rate = 0.03 * (1 - epoch / epochs) + 0.001
            for k, g in grads.items():
                g = np.clip(g, -1, 1).astype(np.float32)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                tagger.p[k] = tagger.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
    return tagger


def train(docs: DataFrame, carriers: int = CARRIERS) -> Tagger:
    """Fit on the texts of at most `carriers` documents of docs(doc_id, text), the ones with the smallest hash."""
    rows = sampled(docs.where("text is not null").select("doc_id", "text"), "doc_id", carriers).collect()
    return fit([r["text"] for r in rows])


#: Digits that an added span has to have, by kind.
_DIGITS = {1: (4, 12), 2: (12, 19), 3: (9, 15)}
_LETTER = re.compile("[^\\W\\d_]")
_AT = re.compile(r"[^\s@]\s*(?:@|[\[(]\s*(?:at|@)\s*[\])]|\sat\s)\s*[^\s@]+\s*(?:\.|\sdot\s|[\[(]\s*dot\s*[\])])", re.IGNORECASE)


def _plausible(span: str, k: int) -> bool:
    """Whether what the tagger marks is of its kind: an address has an "@" or "at" and then a dot, or the word; a number has no letters and as many digits as its kind, an IP address four groups of them."""
    if k == 0:
        return len(span) > 5 and _AT.search(span) is not None
    groups = [x for x in _NOT_DIGIT.split(span) if x]
    return not _LETTER.search(span) and _DIGITS[k][0] <= sum(map(len, groups)) <= _DIGITS[k][1] and (k != 1 or len(groups) == 4)


def added_spans(text: str, parts: list[tuple[int, np.ndarray]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans of tagged parts of a text that are clear of the base spans; each is plausible for its kind."""
    out = [(at + s, k, at + e) for at, y in parts for s, k, e in _decoded(text[at : at + len(y)], y)]
    return _clear(out, base) if base else out


def _clear(spans: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    starts = np.array([b[0] for b in base])
    ends = np.maximum.accumulate([b[2] for b in base])
    keep = []
    for x in spans:
        i = np.searchsorted(starts, x[2]) - 1
        if i < 0 or ends[i] <= x[0]:
            keep.append(x)
    return keep


def _decoded(piece: str, y: np.ndarray) -> Iterator[tuple[int, int, int]]:
    i = 0
    while i < len(y):
        if y[i] and y[i] % 2:
            k, e = int(y[i] - 1) // 2, i + 1
            while e < len(y) and y[e] == y[i] + 1:
                e += 1
            s, stop = i, e
            while s < stop and piece[s].isspace():
                s += 1
            while stop > s and (piece[stop - 1].isspace() or piece[stop - 1] in ".,;"):
                stop -= 1
            if _plausible(piece[s:stop], k):
                yield s, k, stop
            i = e
        else:
            i += 1


def _together(texts: list[str]) -> Iterator[slice]:
    """Slices of texts that have some CHARACTERS characters in all."""
    low = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHARACTERS:
            yield slice(low, i + 1)
            low, size = i + 1, 0
    if low < len(texts):
        yield slice(low, len(texts))


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """A row for each of docs(doc_id, text): doc_id, n_<kind> (base spans), base_sha256, spans (base and added).

    Whole texts in a narrow pass; null text is empty; null doc_ids stay null and repeated rows
    each give a row. Spans are kind:start:end in code points, by start, then kind as listed,
    comma-joined. Other columns are not read, whatever their names. An empty table gives an
    empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
        for b in batches:
            texts = b.column(1).to_pylist()
            for part in _together(texts):
                counts, sums, lines = [], [], []
                for text, tagged in zip(texts[part], shared.value.tag([codes(t) for t in texts[part]])):
                    base = base_spans(text)
                    counts.append([sum(s[1] == k for s in base) for k in range(len(KINDS))])
                    sums.append(hashlib.sha256(line(base).encode()).hexdigest())
                    lines.append(line(base + added_spans(text, tagged, base)))
                yield pa.RecordBatch.from_arrays([b.column(0)[part], *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))), pa.array(sums, pa.string()), pa.array(lines, pa.string())], ["doc_id", *names, "base_sha256", "spans"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id bigint, {', '.join(n + ' bigint' for n in names)}, base_sha256 string, spans string")
