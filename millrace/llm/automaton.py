"""A lexicon's trie intersected with Levenshtein automata of distance one, made deterministic on use."""

from __future__ import annotations

EXACT, NEAR = 2, 1


class Automaton:
    """Accepts the lexicon's words, words that begin with one of its stems, and misspelled words.

    A state is a set of (trie node, errors) pairs, found when first needed. Misspelled means one
    substitution, insertion, deletion or swap of neighbours after the first letter, in a word of
    ``least`` letters or more; stems allow none.
    """

    def __init__(self, words: list[str], stems: list[str], least: int = 5):
        self.children: list[dict[str, int]] = [{}]
        self.word, self.stem, self.height = [False], [False], [0]
        for term in words:
            node = self._add(term)
            self.word[node] = True
            self._mark(term, len(term) >= least)
        for term in stems:
            self.stem[self._add(term)] = True
        self.memo: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.kind: list[int] = []
        self.begin = self._number(frozenset({(0, 0, "")}))

    def _add(self, term: str) -> int:
        node = 0
        for c in term:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.word.append(False)
                self.stem.append(False)
                self.height.append(0)
            node = self.children[node][c]
        return node

    def _mark(self, term: str, fuzzy: bool) -> None:
        """Nodes on the way to a word that may be misspelled."""
        node = 0
        for c in term:
            node = self.children[node][c]
            self.height[node] |= fuzzy

    def _number(self, state: frozenset) -> int:
        if state not in self.memo:
            self.memo[state] = len(self.states)
            self.states.append(state)
            self.next.append({})
            self.kind.append(self._kind(state))
        return self.memo[state]

    def _kind(self, state: frozenset) -> int:
        kind = 0
        for node, errors, due in state:
            if due == "*":
                return EXACT
            if due:
                continue
            if self.word[node]:
                kind = max(kind, EXACT if errors == 0 else NEAR * self.height[node])
            if errors == 0 and node and any(self.word[c] and self.height[c] for c in self.children[node].values()):
                kind = max(kind, NEAR)  # the last letter is missing
        return kind

    def _step(self, state: frozenset, c: str) -> int:
        """Number of the state after ``c``; -1 if none is left."""
        out = set()
        for node, errors, due in state:
            if due == "*":
                return self._number(frozenset({(node, errors, "*")}))
            if due:
                if c == due:
                    out.add((node, 1, ""))
                continue
            child = self.children[node].get(c)
            if child is not None:
                if errors == 0 and self.stem[child]:
                    return self._number(frozenset({(child, 0, "*")}))
                if errors == 0 or self.height[child]:
                    out.add((child, errors, ""))
            if errors or not node:
                continue
            if self.height[node]:
                out.add((node, 1, ""))  # c is one letter too many
            for x, other in self.children[node].items():
                if not self.height[other]:
                    continue
                out.add((other, 1, ""))  # c in place of x
                skipped = self.children[other].get(c)
                if skipped is not None and self.height[skipped]:
                    out.add((skipped, 1, ""))  # x is missing
                    if x != c:
                        out.add((skipped, 1, x))  # x comes after c: swapped
        return self._number(frozenset(out)) if out else -1

    def match(self, word: str) -> int:
        """EXACT for a word of the lexicon or with one of its stems, NEAR if misspelled, else 0."""
        at = self.begin
        for c in word:
            table = self.next[at]
            to = table.get(c)
            if to is None:
                to = table[c] = self._step(self.states[at], c)
            if to < 0:
                return 0
            at = to
        return self.kind[at]
