"""The chunkers written as loops over one text: what the expressions are held against."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np

from loomline.functions.text import ENDS
from loomline.operators.chunkers import Config
from loomline.operators.grouping import vector_groups


@dataclass
class Chunk:
    content: str
    index: int
    start: int
    end: int
    metadata: dict

    @classmethod
    def of(cls, content: str, index: int, method: str, **metadata: object) -> Chunk:
        return cls(content, index, 0, len(content), {"chunk_method": method, **metadata})


def split_sentences(text: str, language: str) -> list[str]:
    parts = (" ".join(p.split()) for p in re.split(ENDS["zh" if language == "zh" else "en"], text))
    return [p for p in parts if p]


def _whole(text: str, method: str, **metadata: object) -> list[Chunk]:
    return [Chunk.of(text, 0, method, is_complete_text=True, **metadata)]


def merge_small(chunks: Iterable[Chunk], config: Config) -> list[Chunk]:
    """Drops blank chunks; joins a small one to its predecessor if both stay within 1.5 chunk sizes. Indexes keep their gaps."""
    out: list[Chunk] = []
    for c in chunks:
        if config.remove_empty_chunks and not c.content.strip():
            continue
        if out and len(c.content) < config.min_chunk_size and len(out[-1].content) + len(c.content) <= 1.5 * config.chunk_size:
            out[-1] = Chunk(f"{out[-1].content} {c.content}", out[-1].index, out[-1].start, c.end, out[-1].metadata | c.metadata)
        else:
            out.append(c)
    return out


def _word_spans(n: int, window: int, step: int) -> list[tuple[int, bool]]:
    """(first word, whether it is the added last window) of every window."""
    spans = [(i, False) for i in range(0, n - window + 1, step)]
    return spans + [(n - window, True)] * (n % step != 0)


def sliding_words(text: str, config: Config) -> list[Chunk]:
    words, size = text.split(), config.window_size
    if len(words) <= size:
        return _whole(text, "sliding_window_words", word_count=len(words))
    at = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).tolist()
    chunks: list[Chunk] = []
    for first, last in _word_spans(len(words), size, config.step_size):
        content = " ".join(words[first : first + size])
        if last and chunks and chunks[-1].content == content:
            continue
        flags = {"is_final_chunk": True} if last else {"overlap_with_previous": first > 0, "overlap_with_next": first + size < len(words)}
        chunks.append(Chunk(content, len(chunks), at[first], len(text) if last else at[first] + len(content), {"chunk_method": "sliding_window_words", "word_count": size, "word_start_index": first, "word_end_index": first + size, **flags}))
    return merge_small(chunks, config)


def _filled(lengths: list[int], start: int, room: Callable[[int, int], bool]) -> int:
    """End of the run from start that grows while room(items, total) allows another item."""
    end, total = start, 0
    while end < len(lengths) and room(end - start, total):
        total += lengths[end]
        end += 1
    return end


def sliding_sentences(text: str, config: Config) -> list[Chunk]:
    parts = [p for p in (s.strip() for s in re.split(ENDS["mixed"], text)) if p]
    counts, chunks, start = [len(p.split()) for p in parts], [], 0
    while start < len(parts):
        end = _filled(counts, start, lambda _, words: words < config.window_size)
        content = ". ".join(parts[start:end])
        follow = start + config.step_size if chunks and config.step_size < end - start else end
        chunks.append(Chunk.of(
            content if content.endswith(".") else content + ".", len(chunks), "sliding_window_sentences", sentence_count=end - start, word_count=sum(counts[start:end]),
            sentence_start_index=start, sentence_end_index=end, overlap_with_previous=bool(chunks), overlap_with_next=follow < len(parts),
        ))
        start = follow
    return merge_small(chunks, config)


def sliding_window(text: str, config: Config) -> list[Chunk]:
    """Windows of words, or of whole sentences."""
    return (sliding_sentences if config.use_sentences else sliding_words)(text, config)


def _join(parts: list[str], config: Config) -> str:
    return ("" if config.language == "zh" else " ").join(parts)


def sentence_runs(text: str, config: Config) -> list[Chunk]:
    parts = split_sentences(text, config.language)
    if len(parts) <= config.max_sentences:
        return _whole(text, "sentence_complete", sentence_count=len(parts)) if parts else []
    lengths, chunks, start = [len(p) for p in parts], [], 0
    while start < len(parts):
        end = _filled(lengths, start, lambda n, size: n < config.max_sentences and size < config.chunk_size)
        end = max(end, min(len(parts), start + config.min_sentences))
        content = _join(parts[start:end], config)
        back = config.sentence_overlap if chunks else 0
        chunks.append(Chunk.of(
            content, len(chunks), "sentence_based", sentence_count=end - start, word_count=len(content.split()), sentence_start_index=start, sentence_end_index=end,
            has_overlap=back > 0, overlap_sentences=back,
        ))
        start = end - min(back, end - start - 1)
    return merge_small(chunks, config)


def _paragraph(text: str, parts: list[str], number: int, config: Config) -> Iterator[tuple[str, str, dict]]:
    if len(parts) <= config.max_sentences:
        yield text, "paragraph_complete", {"paragraph_index": number, "sentence_count": len(parts), "is_complete_paragraph": True}
        return
    for first in range(0, len(parts), config.max_sentences - config.sentence_overlap):
        window = parts[first : first + config.max_sentences]
        yield _join(window, config), "paragraph_sentence_split", {"paragraph_index": number, "sentence_count": len(window), "sentence_start_index": first, "sentence_end_index": first + len(window), "is_paragraph_part": True}


def _paragraphs(texts: list[str], config: Config) -> Iterator[tuple[str, str, dict]]:
    """A short paragraph is shown with those after it that fit; these then also stand for themselves."""
    parts = [split_sentences(t, config.language) for t in texts]
    for i, own in enumerate(parts):
        if not own:
            continue
        if len(own) < config.min_sentences:
            end = i + 1 + _filled([len(p) for p in parts[i + 1 :]], 0, lambda n, total, i=i, own=own: i + 1 + n < len(parts) and len(own) + total + len(parts[i + 1 + n]) <= config.max_sentences)
            total = sum(map(len, parts[i:end]))
            if total >= config.min_sentences:
                yield "\n\n".join(texts[i:end]), "paragraph_combined", {"paragraph_count": end - i, "sentence_count": total, "paragraph_start_index": i, "paragraph_end_index": end}
                continue
        yield from _paragraph(texts[i], own, i, config)


def by_sentences(text: str, config: Config) -> list[Chunk]:
    """Runs of whole sentences, within paragraphs if asked."""
    texts = [p.strip() for p in text.split("\n\n") if p.strip()] if config.paragraphs else []
    if not texts:
        return sentence_runs(text, config)
    made = enumerate(_paragraphs(texts, config))
    return merge_small([Chunk.of(content, i, method, word_count=len(content.split()), **metadata) for i, (content, method, metadata) in made], config)


def _lexical_groups(parts: list[str], config: Config) -> Iterator[list[int]]:
    """Greedy groups around the first free sentence; a group's words grow with its members."""
    words, free = [set(p.split()) for p in parts], dict.fromkeys(range(len(parts)))
    while free:
        leader = next(iter(free))
        del free[leader]
        group, seen, size = [leader], set(words[leader]), len(parts[leader])
        for j in list(free):
            low, high = sorted((len(seen), len(words[j])))
            if low < config.similarity * high:
                continue
            both = len(seen & words[j])
            if both >= config.similarity * (low + high - both):
                del free[j]
                group.append(j)
                seen |= words[j]
                size += len(parts[j])
                if size > config.chunk_size:
                    break
        yield group


def _groups(parts: list[str], config: Config, encode: Callable[[list[str]], np.ndarray] | None) -> list[list[int]]:
    """Groups by vectors; by words where there is no encoder or it fails."""
    if encode:
        try:
            return list(vector_groups(parts, config.similarity, config.chunk_size, config.batch, encode))
        except Exception:  # noqa: BLE001
            pass
    return list(_lexical_groups(parts, config))


def semantic(text: str, config: Config, encode: Callable[[list[str]], np.ndarray] | None = None) -> list[Chunk]:
    """Groups of similar sentences, which need not be neighbours; an encoder that fails gives way to words."""
    parts = split_sentences(text, config.language)
    if len(parts) <= config.min_similarity_sentences:
        return _whole(text, "semantic_complete", sentence_count=len(parts), similarity_score=1.0)
    chunks = []
    for i, group in enumerate(map(sorted, _groups(parts, config, encode))):
        content = " ".join(f"句子{j}" if config.placeholder else parts[j] for j in group)
        likeness = 1.0 if len(group) == 1 else max(0.5, 1.0 - (len(group) - 1) * 0.1)
        chunks.append(Chunk.of(content, i, "semantic_similarity", sentence_count=len(group), sentence_indices=group, avg_similarity=likeness, similarity_threshold=config.similarity, word_count=len(content.split())))
    return merge_small(chunks, config)


KINDS = {"sliding_window": sliding_window, "sentence": by_sentences, "semantic": semantic}


def plain_chunks(text: str | None, kind: str, config: Config | None = None, **extra: object) -> list[Chunk]:
    return KINDS[kind](text, config or Config(), **extra) if text and text.strip() else []
