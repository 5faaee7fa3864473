"""Plain versions of the operators, for small inputs."""

import collections
import html
import math
import re

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text, n=5):
    words = blank_words(text)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard_links(texts, similarity=0.8, n=5):
    """Links of a list of texts, by place."""
    sets = [shingles(t, n) for t in texts]
    out = collections.defaultdict(set)
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= similarity * len(sets[a] | sets[b]) - 1e-9:
                out[a].add(b)
                out[b].add(a)
    return out


def components(n, links):
    root = list(range(n))
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root[i] = min(seen)
    return root


def without_runs(texts, least):
    """The words of each text that lie in no ``least`` words in a row that stand earlier,
    in a text before it or before them in their own, not overlapping."""
    first, out = {}, []
    for number, text in enumerate(texts):
        words = blank_words(text)
        gone = set()
        for i in range(len(words) - least + 1):
            other, at = first.setdefault(tuple(words[i : i + least]), (number, i))
            if other != number or i - at >= least:
                gone.update(range(i, i + least))
        out.append([w for i, w in enumerate(words) if i not in gone])
    return out


def contamination(text, items, window=10):
    """Words, hit places and items (id, text) found in a text."""
    words, hit, found = item_words(text), set(), set()
    for item, passage in items:
        mine = item_words(passage)
        size = min(window, len(mine))
        spans = {tuple(mine[i : i + size]) for i in range(len(mine) - size + 1)} if mine else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in spans:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(words), hit, sorted(found)


def best_segmentation(word, scores, unknown):
    """The best sum of scores and its pieces; the longest piece wins ties."""
    best = [(0.0, [])]
    for end in range(1, len(word) + 1):
        choice = None
        for start in range(end):
            piece = word[start:end]
            score = scores.get(piece, unknown if end - start == 1 else None)
            if score is not None and (choice is None or best[start][0] + score > choice[0]):
                choice = (best[start][0] + score, [*best[start][1], piece])
        best.append(choice)
    return best[-1]


def article(page):
    """Blocks of an article element that has only headings and paragraphs."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


class KneserNey:
    """Interpolated modified Kneser-Ney over pairs of words."""

    def __init__(self, texts, discounts):
        self.words, self.pairs = collections.Counter(), collections.Counter()
        for text in texts:
            words = [*blank_words(text), None]
            self.words.update(words)
            self.pairs.update(zip(["begin", *words[:-1]], words))
        self.total, self.distinct = sum(self.words.values()), len(self.words)
        self.backs = collections.Counter(b for _, b in self.pairs)

        def spread(counts):
            return [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]

        self.off = discounts(spread(self.pairs))
        self.off_back = discounts(spread(self.backs))
        self.follow = collections.Counter()
        self.left = collections.Counter()
        for (a, _), c in self.pairs.items():
            self.follow[a] += c
            self.left[a] += self.off[min(c, 3) - 1]

    def lower(self, word):
        many = len(self.pairs)
        if not many:
            return 1 / (self.distinct + 1)
        left = sum(self.off_back[min(c, 3) - 1] for c in self.backs.values()) / many
        count = self.backs.get(word, 0)
        own = (count - self.off_back[min(count, 3) - 1]) / many if count else 0
        return own + left / (self.distinct + 1)

    def chance(self, before, word):
        if not self.follow.get(before):
            return self.lower(word)
        count = self.pairs.get((before, word), 0)
        own = count - self.off[min(count, 3) - 1] if count else 0
        return (own + self.left[before] * self.lower(word)) / self.follow[before]

    def score(self, text):
        words = [*blank_words(text), None]
        return sum(math.log10(self.chance(a, b)) for a, b in zip(["begin", *words[:-1]], words))

    def base(self, text):
        words = [*blank_words(text), None]
        low = self.total + self.distinct + 1
        return sum(math.log10((self.words.get(w, 0) + 1) / low) for w in words)
