"""Ids of texts as the tokenizer of a JSON file gives them.

Where the file is a plain byte-level BPE whose merges are numbered in their order, the ids are those of merging by rank.
Texts of characters up to U+024F without added tokens are encoded that way, which takes a quarter of the time; the others,
and those of other files, by the file's own library. The tests compare both.
"""

import json
import os
import re

#: The pre-token pattern of byte-level BPE files that name none (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER_CHARACTER = re.compile(r"[^\x00-ɏ]")


def read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def cuts_byte_level(model: dict) -> bool:
    """Whether texts are cut by the plain pattern alone, with no look behind and nothing added."""
    cutter = model.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    fixed = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in model.get("added_tokens") or [])
    return bool(plain and fixed and not model.get("normalizer"))


def added_tokens(model: dict) -> list[str]:
    return [t["content"] for t in model.get("added_tokens") or []]


def byte_of_character() -> dict[str, int]:
    """The bytes that stand for characters in such files: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks(model: dict) -> dict[bytes, int] | None:
    """Token bytes to id, if merging by rank gives what the file's merges give."""
    bpe = model["model"]
    if bpe.get("type") not in (None, "BPE") or not cuts_byte_level(model):
        return None
    if any(bpe.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in bpe["merges"]]
    ids = [bpe["vocab"].get(j) for j in joined]
    if None in ids or ids != sorted(ids) or len(set(ids)) < len(ids):
        return None
    byte = byte_of_character()
    special = set(added_tokens(model))
    plain = {t: i for t, i in bpe["vocab"].items() if t not in special}
    singles = {t for t in plain if len(t) == 1}
    if singles != set(byte) or len(plain) != len(singles) + len(joined):
        return None
    return {bytes(byte[c] for c in t): i for t, i in plain.items()}


def library(path: str):
    """The file's own tokenizer, on one thread, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encoder(path: str):
    """A function from a text to its ids, without special tokens added. Build one in each task; it keeps no texts."""
    own, model = library(path), read(path)
    by_rank = ranks(model)

    def encode_own(text):
        return own.encode_batch_fast([text], add_special_tokens=False)[0].ids

    if by_rank is None:
        return encode_own
    import tiktoken

    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=by_rank, special_tokens={}).encode_ordinary
    added = added_tokens(model)

    def encode(text):
        if OTHER_CHARACTER.search(text) or any(t in text for t in added):
            return encode_own(text)
        return fast(text)

    return encode
