"""Brute-force versions shared by the tests of this folder."""

import public_tokenizers as tokenizers
import tiktoken
from test_jaccard import shingles
from test_lines import brute as brute_lines  # noqa: F401

from scanloom.llm import bpe

_RANKS = bpe.read_ranks(open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
_LIBRARY = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=_RANKS, special_tokens={})


def library_ids(text):
    return _LIBRARY.encode_ordinary(text)


def brute_components(rows, size, percent):
    """(id, set size, smallest id of the component) of each row, rows of one id together."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] and sets[i] and sets[j] or both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        key = find(i)
        low[key] = min((x for x in (low.get(key), d) if x is not None), default=None)
    return [(d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)]
