"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAV, expanded to PCM and resampled."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import slices

RATE, BLOCK = 8000, 64
#: Samples of an ADPCM block: one in its header of four bytes, two in each other byte.
BLOCK_SAMPLES = 1 + 2 * (BLOCK - 4)
#: Fixed values of the WAV format: tags of the codings.
TAGS = {"pcm": 1, "alaw": 6, "ulaw": 7, "adpcm": 17}
CODECS = ("ulaw", "alaw", "adpcm")

# Fixed values of IMA ADPCM: change of the step index for each code, and the steps.
_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
_STEPS = np.array(
    [
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130,
        143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282,
        1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493,
        10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
    ],
    np.int32,
)


def _ulaw_table() -> np.ndarray:
    """G.711 mu-law: complemented bytes of sign, exponent and mantissa, with a bias of 132."""
    code = ~np.arange(256, dtype=np.int32) & 255
    size = (((code & 15) << 3) + 132 << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    """G.711 A-law: every other bit inverted; the lowest segment is linear."""
    code = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, size = (code >> 4) & 7, ((code & 15) << 4) + 8
    size = np.where(exponent > 0, size + 256 << np.maximum(exponent - 1, 0), size)
    return np.where(code & 128, size, -size).astype(np.int16)


ULAW, ALAW = _ulaw_table(), _alaw_table()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """Samples of blocks (a row of bytes each), all of them a step at a time; a step index beyond the table counts as its last."""
    sample = blocks[:, 0].astype(np.int32) | (blocks[:, 1].astype(np.int32) << 8)
    sample = np.where(sample >= 32768, sample - 65536, sample)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(_STEPS) - 1)
    out = np.empty((1 + 2 * (blocks.shape[1] - 4), len(blocks)), np.int16)
    out[0] = sample
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(1, len(out)):
        byte = codes[(k - 1) // 2]
        code = (byte >> 4 if k % 2 == 0 else byte & 15).astype(np.int32)
        step = _STEPS[index]
        move = (step >> 3) + (step >> 2) * (code & 1) + (step >> 1) * (code >> 1 & 1) + step * (code >> 2 & 1)
        sample = np.clip(np.where(code & 8, sample - move, sample + move), -32768, 32767)
        index = np.clip(index + _CHANGE[code & 7], 0, len(_STEPS) - 1)
        out[k] = sample
    return out.T


def write_wav(codec: str, payload: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file with the payload as its samples (ADPCM: its blocks of 64 bytes)."""
    if codec == "adpcm":
        form = struct.pack("<HHIIHHHH", TAGS[codec], 1, rate, rate * BLOCK // BLOCK_SAMPLES, BLOCK, 4, 2, BLOCK_SAMPLES)
        samples = len(payload) // BLOCK * BLOCK_SAMPLES
    else:
        width = 2 if codec == "pcm" else 1
        form = struct.pack("<HHIIHHH", TAGS[codec], 1, rate, rate * width, width, 8 * width, 0)
        samples = len(payload) // width
    parts = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(payload)) + payload
    return b"RIFF" + struct.pack("<I", len(parts)) + parts


def read_wav(media: bytes) -> tuple[str, int, bytes]:
    """Codec, rate and payload of a file that write_wav made."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, codec, rate = 12, "", 0
    while at < len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
            codec = {t: c for c, t in TAGS.items()}[tag]
        elif name == b"data":
            return codec, rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def _halfway(taps: int = 16) -> np.ndarray:
    """Weights of the samples around a point halfway between two: a windowed sinc of sum 1."""
    at = np.arange(taps) - taps / 2 + 0.5
    weights = np.sinc(at) * (0.5 + 0.5 * np.cos(2 * np.pi * at / taps))
    return weights / weights.sum()


_HALFWAY = _halfway()


def double_rate(pcm: np.ndarray) -> np.ndarray:
    """Twice the samples: those given, and between each and the next (zero behind the last) a band-limited one."""
    out = np.empty(2 * len(pcm), np.int16)
    out[::2] = pcm
    reach = len(_HALFWAY) // 2
    between = np.convolve(np.pad(pcm.astype(np.float64), (reach - 1, reach)), _HALFWAY, mode="valid")
    out[1::2] = np.clip(np.rint(between), -32768, 32767)
    return out


def expand(coded: list[tuple[str, bytes]]) -> list[np.ndarray]:
    """PCM of coded payloads; the ADPCM blocks of all of them are decoded together."""
    blocks = [np.frombuffer(p, np.uint8).reshape(-1, BLOCK) for c, p in coded if c == "adpcm"]
    decoded = decode_adpcm(np.concatenate(blocks)) if blocks else None
    out, at = [], 0
    for codec, payload in coded:
        if codec == "adpcm":
            n = len(payload) // BLOCK
            out.append(decoded[at : at + n].ravel())
            at += n
        else:
            out.append((ULAW if codec == "ulaw" else ALAW)[np.frombuffer(payload, np.uint8)])
    return out


def describe(codec: str, rate: int, pcm: np.ndarray) -> str:
    """Codec, rate, number of samples, peak, root mean square and zero crossings per 1000 samples, as whole numbers."""
    wide = pcm.astype(np.int64)
    crossings = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
    return f"{codec};rate={rate};samples={len(pcm)};peak={int(np.abs(wide).max())};rms={int(np.sqrt(np.mean(wide * wide)))};crossings={crossings * 1000 // len(pcm)}"


def store_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text of documents(doc_id, text) as the samples of a WAV file.

    The payload is the text in UTF-8 (null: empty) with bytes 0 up to a positive multiple of 64, so it holds whole ADPCM blocks;
    its CRC-32 chooses the coding, so equal texts have equal files.  Null ids and repeated rows stay; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                media, sizes = [], []
                for text in part.column(1).to_pylist():
                    raw = (text or "").encode()
                    payload = raw.ljust(max(1, -(-len(raw) // BLOCK)) * BLOCK, b"\0")
                    media.append(write_wav(CODECS[zlib.crc32(payload) % len(CODECS)], payload))
                    sizes.append(len(raw))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


_FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm_bytes long, pcm_sha256 string"


def decode_media(stored: DataFrame, with_pcm: bool = False) -> DataFrame:
    """Read the WAV files of stored(doc_id, n_bytes, media), expand and resample them to 16 kHz.

    Returns doc_id, n_bytes, what the payload and the file are, a feature string of the resampled samples, and size and
    digest of the PCM file; with_pcm adds that file as `pcm`, to be stored.
    """
    names = ["doc_id", "n_bytes", *[x.split()[0] for x in _FEATURES.split(", ")], "pcm"][: 10 + with_pcm]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "media", 1 << 20):
                files = part.column("media").to_pylist()
                read = [read_wav(m) for m in files]
                rows = []
                for doc, size, file, (codec, rate, payload), pcm in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), files, read, expand([(c, p) for c, _, p in read]), strict=True):
                    twice = double_rate(pcm)
                    wav = write_wav("pcm", twice.astype("<i2").tobytes(), 2 * rate)
                    row = (doc, size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(file), hashlib.sha256(file).hexdigest(), describe(codec, 2 * rate, twice), len(wav), hashlib.sha256(wav).hexdigest(), wav)
                    rows.append(row[: len(names)])
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=False)], names=names)

    return stored.mapInArrow(run, "doc_id long, n_bytes long, " + _FEATURES + ", pcm binary" * with_pcm)
