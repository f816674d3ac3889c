"""Adaptive context-mixing range coder for token ids, in independent blocks.

A block holds at most `BLOCK_IDS` ids and starts from an empty model; the blocks of a group are coded
side by side, one numpy step for each place, so that a step costs little more for a thousand blocks than
for one. In a block an id is known by the number of its first appearance there, from 1.

Three predictions are mixed for every id:

* order 2: the number that last followed the two before it (a slot chosen by their hash);
* order 1: the number that last followed the one before it;
* order 0: counts of the numbers that orders 1 and 2 missed so far, and of first appearances, for which number 0
  stands. A first appearance is followed by the id itself, all ids alike.

Orders 1 and 2 name one number and how often in a row it came true, 0 to 3. The mixture's weights are learned:
for every pair of those confidences, and whether both name the same number, the block counts how often
order 2, else order 1, else neither was right. The mixture is coded in two parts: by its weights, which is the
first order that is right; then, if neither named it, the number by the counts of order 0. Both drive a range
coder with 64 bits of state, words of 32 bits and carries. All arithmetic is in integers, so every machine
decodes what any machine wrote.

An encoded block is `HEADER` (mark, ids, their CRC-32, words) and its words, little-endian. The checksum
is compared after decoding.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd

#: Numbers 0 to 1023 fit two digits of 32; 0 stands for a first appearance.
BLOCK_IDS = 1023
#: Blocks that are coded side by side.
LANES = 4096
HEADER = "<4sIII"
HEADER_BYTES = struct.calcsize(HEADER)
MARK = b"tid1"

DIGITS, DIGIT_BITS = 32, 5
NUMBERS = DIGITS ** 2
PAIR_SLOTS = 1 << 10
U64 = np.uint64
#: What a count adds to its row's totals: digit d counts for the places after d.
STEPS = (np.arange(DIGITS)[:, None] < np.arange(DIGITS)).astype(np.uint16)
#: Which order was right, by (order 2 was) * 2 + (order 1 was): 0 for order 2, 1 for order 1, 2 for neither.
OUTCOMES = np.array([2, 1, 0, 0])
#: The next confidence, by (it came true) * 4 + confidence.
CONFIDENCES = np.array([1, 1, 1, 1, 1, 2, 3, 3], np.uint16)
CONTEXTS = 32


class Damaged(ValueError):
    """A block that is not what was written."""


class Counts:
    """Order 0 of each lane: counts of numbers, whose two digits of 32 lead through rows of running totals, and of first appearances."""

    def __init__(self, lanes: int):
        self.upper, self.lower = (np.zeros((lanes * DIGITS ** depth, DIGITS), np.uint16) for depth in range(2))
        # The same memory as single numbers, and as whole rows.
        self.upper_flat, self.lower_flat = self.upper.reshape(-1), self.lower.reshape(-1)
        self.upper_rows, self.lower_rows = (rows.view(f"V{2 * DIGITS}").reshape(-1) for rows in (self.upper, self.lower))
        self.own = np.zeros(lanes * NUMBERS, np.uint16)
        self.fresh = np.ones(lanes, np.int64)
        self.total = np.ones(lanes, np.int64)

    def add(self, lanes: np.ndarray, number: np.ndarray) -> None:
        """Counts a number above 0 in each of the lanes."""
        digit = number >> DIGIT_BITS
        for rows, whole, row, place in (
            (self.upper, self.upper_rows, lanes, digit), (self.lower, self.lower_rows, lanes * DIGITS + digit, number & (DIGITS - 1)),
        ):
            changed = rows.take(row, axis=0)
            changed += STEPS.take(place, axis=0)
            np.put(whole, row, changed.view(f"V{2 * DIGITS}").reshape(-1))
        at = lanes * NUMBERS + number
        np.put(self.own, at, self.own.take(at) + np.uint16(1))
        self.total[lanes] += 1

    def add_fresh(self, lanes: np.ndarray) -> None:
        self.fresh[lanes] += 1
        self.total[lanes] += 1

    def interval(self, lanes: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of each lane's number in a range of `total`; first appearances come first."""
        fresh = self.fresh.take(lanes)
        at = lanes * NUMBERS + number
        start = fresh + self.upper_flat.take(lanes * DIGITS + (number >> DIGIT_BITS))
        start += self.lower_flat.take(at)
        known = number > 0
        return start * known, np.where(known, self.own.take(at), fresh)

    def find(self, lanes: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number whose interval holds the target, and the interval."""
        fresh = self.fresh.take(lanes)
        left = target - fresh
        known = left >= 0
        left = np.maximum(left, 0).astype(np.uint16)
        number, start = 0, fresh.copy()
        for rows, flat, row in ((self.upper, self.upper_flat, lanes), (self.lower, self.lower_flat, lanes * DIGITS)):
            row = row + number
            marks = np.bitwise_count((rows.take(row, axis=0) <= left[:, None]).view(U64)).view(np.uint32).reshape(-1)
            # Four counts of up to 8 in one number: their sum is the upper byte of the product.
            digit = ((marks * np.uint32(0x01010101)) >> np.uint32(24)).astype(np.int64) - 1
            before = flat.take(row * DIGITS + digit)
            left -= before
            start += before
            number = number * DIGITS + digit
        number = number * known
        return number, start * known, np.where(known, self.own.take(lanes * NUMBERS + number), fresh)


class Model:
    """Orders 1 and 2 of every lane, and the weights of the mixture."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes)
        # Predicted number * 4 + confidence; 0 is an empty slot, and no number's.
        self.single, self.first_single = np.zeros(lanes * NUMBERS, np.uint16), lane * NUMBERS
        self.double, self.first_double = np.zeros(lanes * PAIR_SLOTS, np.uint16), lane * PAIR_SLOTS
        confidence = np.arange(CONTEXTS)
        start = np.stack([confidence // 8 > 0, confidence // 2 % 4 > 0, np.ones(CONTEXTS), np.zeros(CONTEXTS)], axis=1)
        self.hits = np.tile(start.astype(np.uint16), (lanes, 1))
        self.hits_flat, self.first_context = self.hits.reshape(-1), lane * CONTEXTS
        self.last, self.before_last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self, active: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predicts the next number in the first `active` lanes; returns the weights of orders 2 and 1, and of all."""
        last = self.last[:active]
        pair = ((self.before_last[:active] * 0x9E3779B1 + last * 0x85EBCA6B) >> 9) & (PAIR_SLOTS - 1)
        self.single_at, self.double_at = self.first_single[:active] + last, self.first_double[:active] + pair
        single, double = self.single.take(self.single_at), self.double.take(self.double_at)
        self.one, self.two = single >> 2, double >> 2
        self.one_sure, self.two_sure = single & 3, double & 3
        self.context = self.first_context[:active] + (self.two_sure * 8 + self.one_sure * 2 + (self.one == self.two))
        hits = self.hits.take(self.context, axis=0)
        two, one = hits[:, 0], hits[:, 0] + hits[:, 1]
        return two, one, one + hits[:, 2]

    def outcome(self, entered: np.ndarray) -> np.ndarray:
        """0 where order 2 named the number, else 1 where order 1 did, else 2."""
        return OUTCOMES.take((self.two == entered) * 2 + (self.one == entered))

    def update(self, entered: np.ndarray, outcome: np.ndarray) -> None:
        """The number that came, `entered`, above 0."""
        at = self.context * 4 + outcome
        np.put(self.hits_flat, at, self.hits_flat.take(at) + np.uint16(1))
        numbers = entered.astype(np.uint16)
        for table, at, guess, sure in ((self.double, self.double_at, self.two, self.two_sure), (self.single, self.single_at, self.one, self.one_sure)):
            came = guess == numbers
            held = np.where(came | (sure > 1), guess, numbers)
            held <<= 2
            held |= CONFIDENCES.take(came * 4 + sure)
            np.put(table, at, held)
        active = len(entered)
        self.before_last[:active] = self.last[:active]
        self.last[:active] = entered


class Writer:
    """A range encoder for each lane."""

    def __init__(self, lanes: int, places: int):
        self.low, self.range = np.zeros(lanes, U64), np.full(lanes, ~U64(0))
        self.words, self.used = np.zeros((lanes, 2 * places + 3), np.uint32), np.zeros(lanes, np.int64)

    def narrow(self, lanes: np.ndarray | slice, start: np.ndarray, size: np.ndarray, total: np.ndarray | int) -> None:
        share = self.range[lanes] // (total.astype(U64) if isinstance(total, np.ndarray) else U64(total))
        low = self.low[lanes]
        moved = low + share * start.astype(U64)
        share *= size.astype(U64)
        carried = np.flatnonzero(moved < low)
        self.low[lanes], self.range[lanes] = moved, share
        ready = np.flatnonzero(share < U64(1 << 32))
        if not isinstance(lanes, slice):
            carried, ready = lanes[carried], lanes[ready]
        if len(carried):
            self._carry(carried)
        if len(ready):
            low = self.low[ready]
            self.words[ready, self.used[ready]] = (low >> U64(32)).astype(np.uint32)
            self.used[ready] += 1
            self.low[ready] = low << U64(32)
            self.range[ready] <<= U64(32)

    def _carry(self, lanes: np.ndarray) -> None:
        back = 1
        while len(lanes):
            at = self.used[lanes] - back
            self.words[lanes, at] += np.uint32(1)
            lanes = lanes[self.words[lanes, at] == 0]
            back += 1

    def finish(self) -> None:
        """One word more: the next multiple of 2**32 lies in the range, which is at least as wide."""
        moved = self.low + U64((1 << 32) - 1)
        self._carry(np.flatnonzero(moved < self.low))
        lanes = np.arange(len(moved))
        self.words[lanes, self.used] = (moved >> U64(32)).astype(np.uint32)
        self.used += 1


class Reader:
    """A range decoder for each lane."""

    def __init__(self, words: np.ndarray):
        self.words, self.used = words, np.full(len(words), 2)
        self.code = (words[:, 0].astype(U64) << U64(32)) | words[:, 1]
        self.range = np.full(len(words), ~U64(0))

    def target(self, lanes: np.ndarray | slice, total: np.ndarray | int) -> np.ndarray:
        total = total.astype(U64) if isinstance(total, np.ndarray) else U64(total)
        self.share = self.range[lanes] // total
        return np.minimum(self.code[lanes] // self.share, total - U64(1)).view(np.int64)

    def narrow(self, lanes: np.ndarray | slice, start: np.ndarray, size: np.ndarray) -> None:
        self.code[lanes] -= self.share * start.astype(U64)
        self.share *= size.astype(U64)
        self.range[lanes] = self.share
        ready = np.flatnonzero(self.share < U64(1 << 32))
        if len(ready):
            ready = ready if isinstance(lanes, slice) else lanes[ready]
            following = self.words[ready, np.minimum(self.used[ready], self.words.shape[1] - 1)]
            self.code[ready] = (self.code[ready] << U64(32)) | following
            self.used[ready] += 1
            self.range[ready] <<= U64(32)


def encode(ids: np.ndarray, ids_in_all: int, block_ids: int = BLOCK_IDS) -> list[bytes]:
    """The blocks of a group of ids below `ids_in_all`; the last one may be shorter."""
    lanes = -(-len(ids) // block_ids)
    if not lanes:
        return []
    places = min(block_ids, len(ids))
    last = len(ids) - (lanes - 1) * block_ids
    kind = np.int32 if lanes * (ids_in_all + 1) < 1 << 31 else np.int64
    plain = np.zeros(lanes * places, kind)
    plain[:len(ids)] = ids
    plain = plain.reshape(lanes, places)
    # Numbers of first appearance: ids of different blocks are different values here, and the last one's padding is another.
    keys = plain + (np.arange(lanes, dtype=kind) * (ids_in_all + 1))[:, None]
    keys[-1, last:] = lanes * (ids_in_all + 1)
    order = pd.factorize(keys.reshape(-1))[0].astype(np.int32)
    del keys
    highest = np.maximum.accumulate(order)
    before = np.r_[np.int32(-1), highest[:-1]].reshape(lanes, places)
    del highest
    order = order.reshape(lanes, places)
    number = (order - before[:, :1]).astype(np.int16)
    coded = np.where(order > before, np.int16(0), number)
    del order, before
    entered, coded, plain = (np.ascontiguousarray(table.T) for table in (number, coded, plain))
    del number
    model, counts, out = Model(lanes), Counts(lanes), Writer(lanes, places)
    for place in range(places):
        active = lanes if place < last else lanes - 1
        now = entered[place, :active].astype(np.int64)
        two, one, every = model.predict(active)
        outcome = model.outcome(now)
        start = np.where(outcome == 0, 0, np.where(outcome == 1, two, one))
        out.narrow(slice(0, active), start, np.where(outcome == 0, two, np.where(outcome == 1, one - two, every - one)), every)
        missed = np.flatnonzero(outcome == 2)
        if len(missed):
            number = coded[place].take(missed).astype(np.int64)
            out.narrow(missed, *counts.interval(missed, number), counts.total.take(missed))
            is_first = number == 0
            first = missed[is_first]
            if len(first):
                out.narrow(first, plain[place].take(first).astype(np.int64), np.ones(len(first), np.int64), ids_in_all)
                counts.add_fresh(first)
            counts.add(missed, now.take(missed))
        model.update(now, outcome)
    out.finish()
    blocks = []
    for lane in range(lanes):
        own = ids[lane * block_ids:(lane + 1) * block_ids].astype("<u4").tobytes()
        used = int(out.used[lane])
        blocks.append(struct.pack(HEADER, MARK, len(own) // 4, zlib.crc32(own), used) + out.words[lane, :used].astype("<u4").tobytes())
    return blocks


def decode(blocks: list[bytes], ids_in_all: int) -> list[np.ndarray]:
    """The ids of each block; raises `Damaged` for a block that is not whole."""
    if not blocks:
        return []
    heads = []
    for data in blocks:
        if len(data) < HEADER_BYTES or data[:4] != MARK:
            raise Damaged("no token block")
        _, n, checksum, used = struct.unpack_from(HEADER, data)
        if len(data) != HEADER_BYTES + 4 * used:
            raise Damaged("a token block of the wrong length")
        heads.append((n, checksum, used))
    # Long blocks first, so that the blocks in use are always the first ones.
    lengths = np.array([n for n, _, _ in heads])
    order = np.argsort(-lengths, kind="stable")
    words = np.zeros((len(blocks), max(used for _, _, used in heads) + 3), np.uint32)
    for lane, k in enumerate(order.tolist()):
        words[lane, :heads[k][2]] = np.frombuffer(blocks[k], "<u4", heads[k][2], HEADER_BYTES)
    lengths = lengths[order]
    places = int(lengths.max(initial=0))
    model, counts, source = Model(len(blocks)), Counts(len(blocks)), Reader(words)
    known = np.zeros(len(blocks) * NUMBERS, np.uint32)
    entries = np.ones(len(blocks), np.int64)
    first_known = np.arange(len(blocks)) * NUMBERS
    ids = np.zeros((places, len(blocks)), np.uint32)
    for place in range(places):
        active = int(np.searchsorted(-lengths, -place, side="left"))
        two, one, every = model.predict(active)
        target = source.target(slice(0, active), every)
        by_one, by_none = target >= two, target >= one
        outcome = by_one.astype(np.int64) + by_none
        start = np.where(by_none, one, two * by_one)
        source.narrow(slice(0, active), start, np.where(by_none, every, np.where(by_one, one, two)) - start)
        entered = np.where(by_one, model.one, model.two).astype(np.int64)
        missed = np.flatnonzero(by_none)
        if len(missed):
            number, start, size = counts.find(missed, source.target(missed, counts.total.take(missed)))
            source.narrow(missed, start, size)
            first = missed[number == 0]
            if len(first):
                plain = source.target(first, ids_in_all)
                source.narrow(first, plain, np.ones(len(first), np.int64))
                number[number == 0] = entries[first]
                known[first * NUMBERS + entries[first]] = plain
                entries[first] += 1
                counts.add_fresh(first)
            entered[missed] = number
            counts.add(missed, number)
        ids[place, :active] = known.take(first_known[:active] + entered)
        model.update(entered, outcome)
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(blocks)
    for at, k in enumerate(order.tolist()):
        own = np.ascontiguousarray(ids[:lengths[at], at], "<u4")
        if zlib.crc32(own.tobytes()) != heads[k][1]:
            raise Damaged("a token block with a wrong checksum")
        out[k] = own
    return out
