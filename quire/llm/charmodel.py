"""A character-level bidirectional LSTM with a CRF on top, in numpy: decoding for the workers, gradients for the training."""

from __future__ import annotations

import unicodedata

import numpy as np

KINDS = ("email", "phone", "id_number", "address", "name")
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
#: Ids of characters: printable ASCII, a class for other white space, Ethiopic by consonant row, other letters by kind.
SIZE = 192


def _id(c: str) -> int:
    o = ord(c)
    if 32 <= o < 127:
        return o - 31
    if c == "\n":
        return 96
    if c.isspace():
        return 1
    if 0x1200 <= o < 0x1380:
        return 100 + min((o - 0x1200) // 8, 47) if o < 0x1360 else 148
    base = unicodedata.normalize("NFD", c)[0]
    if base != c and 32 <= ord(base) < 127:
        return ord(base) - 31
    if c in "ßøæœ":
        return 150
    return 151 if c.isalpha() else 152 if c.isdigit() else 153


_IDS = np.full(0x110000, -1, np.int16)


def encode(text: str) -> np.ndarray:
    """Ids of the characters; those of a character seen for the first time are looked up once."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = _IDS[codes]
    if len(ids) and ids.min() < 0:
        for o in np.unique(codes[ids < 0]):
            _IDS[o] = _id(chr(o))
        ids = _IDS[codes]
    return ids


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Model:
    """Parameters: emb (SIZE, d); for each direction w (d, 4h), u (h, 4h), b (4h); out (2h, tags), ob (tags); crf: trans (tags, tags), start, end."""

    def __init__(self, hidden: int = 40, dim: int = 20, seed: int = 0, params: dict | None = None):
        if params is not None:
            self.p = {k: np.asarray(v, dtype=np.float32) for k, v in params.items()}
            self.h = self.p["uf"].shape[0]
        else:
            r, n, self.h = np.random.default_rng(seed), len(TAGS), hidden
            g = lambda *s: (r.standard_normal(s) * (1.0 / np.sqrt(s[0]))).astype(np.float32)
            self.p = {"emb": (r.standard_normal((SIZE, dim)) * 0.3).astype(np.float32), "out": g(2 * hidden, n), "ob": np.zeros(n, np.float32), "trans": np.zeros((n, n), np.float32), "start": np.zeros(n, np.float32), "end": np.zeros(n, np.float32)}
            for d in "fb":
                b = np.zeros(4 * hidden, np.float32)
                b[hidden : 2 * hidden] = 1.0
                self.p |= {"w" + d: g(dim, 4 * hidden), "u" + d: g(hidden, 4 * hidden), "b" + d: b}
        bad = np.zeros((len(TAGS), len(TAGS)), np.float32)
        for j, t in enumerate(TAGS):
            if t[0] == "I":
                for i, s in enumerate(TAGS):
                    if s[2:] != t[2:] or s == "O":
                        bad[i, j] = -1e4
        self.bad = bad
        self.bad_start = np.array([-1e4 if t[0] == "I" else 0.0 for t in TAGS], np.float32)

    def _run(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list | None]:
        """Hidden states (T, B, h) of one direction over x (B, T)."""
        p, h = self.p, self.h
        table = p["emb"] @ p["w" + d] + p["b" + d]
        b, t = x.shape
        hs, c, cur = np.zeros((t, b, h), np.float32), np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        kept = []
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = table[x[:, i]] + cur @ p["u" + d]
            s = sigmoid(z[:, : 3 * h])
            g = np.tanh(z[:, 3 * h :])
            prev_c, prev_h = c, cur
            c = s[:, h : 2 * h] * c + s[:, :h] * g
            tc = np.tanh(c)
            cur = s[:, 2 * h :] * tc
            real = (x[:, i] > 0)[:, None]
            c, cur = np.where(real, c, 0), np.where(real, cur, 0)
            hs[i] = cur
            if keep:
                kept.append((i, s, g, tc, prev_c, prev_h, real))
        return hs, kept if keep else None

    def _states(self, x: np.ndarray, d: str) -> np.ndarray:
        """_run() without what the gradients need: one tanh for all gates (a sigmoid is a halved tanh of the half), in place."""
        p, h = self.p, self.h
        half = np.concatenate([np.full(3 * h, 0.5, np.float32), np.ones(h, np.float32)])
        table, u = (p["emb"] @ p["w" + d] + p["b" + d]) * half, p["u" + d] * half
        b, t = x.shape
        full = (x > 0).all(axis=0)
        hs, c, cur = np.zeros((t, b, h), np.float32), np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        z, g = np.empty((b, 4 * h), np.float32), np.empty((b, h), np.float32)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            np.matmul(cur, u, out=z)
            z += table[x[:, i]]
            np.tanh(z, out=z)
            s = z[:, : 3 * h]
            s *= 0.5
            s += 0.5
            c *= z[:, h : 2 * h]
            np.multiply(z[:, :h], z[:, 3 * h :], out=g)
            c += g
            np.tanh(c, out=g)
            cur = hs[i]
            np.multiply(z[:, 2 * h : 3 * h], g, out=cur)
            if not full[i]:
                gone = x[:, i] == 0
                c[gone], cur[gone] = 0, 0
        return hs

    def emissions(self, x: np.ndarray, keep: bool = False):
        if not keep:
            both = np.concatenate([self._states(x, "f"), self._states(x, "b")], axis=2)
            return both @ self.p["out"] + self.p["ob"], both, None, None
        f, kf = self._run(x, "f", keep)
        b, kb = self._run(x, "b", keep)
        both = np.concatenate([f, b], axis=2)
        return both @ self.p["out"] + self.p["ob"], both, kf, kb

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags (B, T) of the windows, padding (id 0) as O."""
        e = self.emissions(x)[0]
        t, b, n = e.shape
        trans = self.p["trans"] + self.bad
        score, back = self.p["start"] + self.bad_start + e[0], np.zeros((t, b, n), np.int8)
        for i in range(1, t):
            s = score[:, :, None] + trans
            best = s.argmax(axis=1)
            new = np.take_along_axis(s, best[:, None, :], axis=1)[:, 0] + e[i]
            real = (x[:, i] > 0)[:, None]
            back[i] = np.where(real, best, np.arange(n))
            score = np.where(real, new, score)
        tags = np.zeros((b, t), np.int8)
        cur = (score + self.p["end"]).argmax(axis=1)
        for i in range(t - 1, -1, -1):
            tags[:, i] = cur
            cur = back[i][np.arange(b), cur]
        return np.where(x > 0, tags, 0)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags y (B, T), and its gradients."""
        p, h = self.p, self.h
        e, both, kf, kb = self.emissions(x, keep=True)
        t, b, n = e.shape
        real = (x > 0).T.astype(np.float32)
        trans, start = (p["trans"] + self.bad).astype(np.float64), (p["start"] + self.bad_start).astype(np.float64)
        lse = lambda a, ax: (m := a.max(axis=ax, keepdims=True)).squeeze(ax) + np.log(np.exp(a - m).sum(axis=ax))
        alpha, beta = np.zeros((t, b, n)), np.zeros((t, b, n))
        alpha[0] = start + e[0]
        for i in range(1, t):
            new = lse(alpha[i - 1][:, :, None] + trans, 1) + e[i]
            alpha[i] = np.where(real[i][:, None] > 0, new, alpha[i - 1])
        beta[t - 1] = p["end"]
        for i in range(t - 2, -1, -1):
            new = lse(trans[None] + (e[i + 1] + beta[i + 1])[:, None, :], 2)
            beta[i] = np.where(real[i + 1][:, None] > 0, new, beta[i + 1])
        z = lse(alpha[t - 1] + p["end"], 1)
        marg = np.exp(alpha + beta - z[None, :, None]) * real[:, :, None]
        yt, ar = y.T, np.arange(b)
        gold = start[yt[0]] + e[0][ar, yt[0]]
        d_trans = np.zeros((n, n))
        last = yt[0]
        for i in range(1, t):
            on = real[i] > 0
            gold = gold + np.where(on, trans[yt[i - 1], yt[i]] + e[i][ar, yt[i]], 0)
            pair = np.exp(alpha[i - 1][:, :, None] + trans + (e[i] + beta[i])[:, None, :] - z[:, None, None])
            d_trans += (pair * on[:, None, None]).sum(axis=0)
            np.add.at(d_trans, (yt[i - 1][on], yt[i][on]), -1)
            last = np.where(on, yt[i], last)
        gold = gold + p["end"][last]
        one = np.zeros((t, b, n))
        np.put_along_axis(one, yt[:, :, None].astype(np.int64), 1.0, axis=2)
        de = ((marg - one * real[:, :, None]) / b).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["trans"] = (d_trans / b).astype(np.float32)
        g["start"] = de[0].sum(axis=0)
        fin = np.exp(alpha[t - 1] + p["end"] - z[:, None])
        np.add.at(fin, (ar, last), -1)
        g["end"] = (fin.sum(axis=0) / b).astype(np.float32)
        g["out"], g["ob"] = both.reshape(-1, 2 * h).T @ de.reshape(-1, n), de.sum(axis=(0, 1))
        dboth = de @ p["out"].T
        for d, kept, dh_all in (("f", kf, dboth[:, :, :h]), ("b", kb, dboth[:, :, h:])):
            dh, dc = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
            dtable = np.zeros((SIZE, 4 * h), np.float32)
            for i, s, gg, tc, pc, ph, on in reversed(kept):
                dcur = np.where(on, dh_all[i] + dh, 0)
                o, ii, ff = s[:, 2 * h :], s[:, :h], s[:, h : 2 * h]
                dct = np.where(on, dc, 0) + dcur * o * (1 - tc * tc)
                dz = np.concatenate([dct * gg * ii * (1 - ii), dct * pc * ff * (1 - ff), dcur * tc * o * (1 - o), dct * ii * (1 - gg * gg)], axis=1)
                g["u" + d] += ph.T @ dz
                np.add.at(dtable, x[:, i], dz)
                dh, dc = dz @ p["u" + d].T, dct * ff
            g["b" + d] = dtable.sum(axis=0)
            g["w" + d] = p["emb"].T @ dtable
            g["emb"] += dtable @ p["w" + d].T
        return float((z - gold).mean()), g


class Adam:
    def __init__(self, params: dict, rate: float = 3e-3):
        self.rate, self.t = rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in params.items()} for _ in range(2))

    def step(self, params: dict, grads: dict) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        for k, g in grads.items():
            g = g * scale
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
