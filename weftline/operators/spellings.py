"""Many spellings at once: one automaton over each text, whatever the size of the lexicon.

`lexicon.matches` writes an expression for each spelling, which suits some dozens. Here the
spellings go to the executors as data and the plan has one step for PART characters of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.lexicon import candidates
from weftline.functions.text import EVIDENCE_WINDOW, WHITE_SPACE

HITS = "array<struct<standard:string,evidence:string>>"
_ARROW = pa.list_(pa.struct([("standard", pa.string()), ("evidence", pa.string())]))
#: Characters of spellings that one automaton holds at most, unless one standard has more.
PART = 1_000_000


def parts(group: Mapping[str, Sequence[str]], most: int = PART) -> list[list[tuple[str, str, int]]]:
    """(spelling, standard, rank) in parts of at most so many characters; a standard is within one part.

    The smaller the rank, the sooner a spelling decides for its standard.
    """
    by_standard: dict[str, list[tuple[str, str, int]]] = {}
    for rank, (spelling, standard) in enumerate(candidates(group)):
        by_standard.setdefault(standard, []).append((spelling, standard, rank))
    out, held = [], 0
    for spellings in by_standard.values():
        size = sum(len(s) for s, _, _ in spellings)
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1] += spellings
        held += size
    return out


def automaton(spellings: Sequence[tuple[str, str, int]]):
    """An Aho-Corasick automaton that gives (length, [(standard, rank)]) at the end of each spelling."""
    import ahocorasick

    built, owners = ahocorasick.Automaton(), {}
    for spelling, standard, rank in spellings:
        owners.setdefault(spelling, []).append((standard, rank))
    for spelling, whose in owners.items():
        built.add_word(spelling, (len(spelling), whose))
    built.make_automaton()
    return built


def hits_of(text: str, built, width: int = EVIDENCE_WINDOW) -> list[dict[str, str]]:
    """One hit for each standard in a text, by its spelling of smallest rank, at its first place; memory is a hit a standard."""
    best: dict[str, tuple[int, int, int]] = {}
    for end, (length, whose) in built.iter(text):
        for standard, rank in whose:
            if standard not in best or rank < best[standard][0]:  # places come in order, so the first stays
                best[standard] = (rank, end - length + 1, length)
    return [{"standard": s, "evidence": text[max(at - width, 0) : at + n + width].strip(WHITE_SPACE)} for s, (_, at, n) in best.items()]


def with_hits(df: DataFrame, text: str, group: Mapping[str, Sequence[str]], name: str = "hits", width: int = EVIDENCE_WINDOW, most: int = PART) -> DataFrame:
    """df with an array of (standard, evidence), as `lexicon.matches` gives them, in the order of the standards' names.

    A null text has no hits. Rows are worked on one by one in Arrow batches.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    columns, names = df.columns, []
    for i, spellings in enumerate(parts(group, most)):
        names.append(f"_{name}_{i}")
        # As a broadcast, a part is sent once to an executor, not with each task; it is PART characters at most.
        sent, at = df.sparkSession.sparkContext.broadcast(spellings), df.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, at=at, new=names[-1]) -> Iterator[pa.RecordBatch]:
            built = automaton(sent.value)
            for b in batches:
                found = pa.array([hits_of(t, built, width) if t else [] for t in b.column(at).to_pylist()], _ARROW)
                yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, new])

        kinds += f", `{names[-1]}` {HITS}"
        df = df.mapInArrow(run, kinds)
    every = F.concat(*[F.col(n) for n in names]) if names else F.array().cast(HITS)
    return df.select(*columns, F.sort_array(every).alias(name))
