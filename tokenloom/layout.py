"""Token id layout of the two model stages.

Fixed values that must equal the reference model's vocabulary layout:
first stage  -- codebook size 1024, end-of-audio (and input pad) 2048,
                text offset 2049, end-of-text 2561, loss-ignore -1;
second stage -- end-of-audio (and pad) 1024, text offset 1025,
                end-of-text 1537.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TokenLayout:
    codebook_size: int   # values per audio codebook
    eoa: int             # end-of-audio marker, also the input pad value
    text_offset: int     # added to raw text ids
    text_vocab: int      # raw text vocabulary incl. end-of-text
    loss_ignore: int = -1

    @property
    def eot(self) -> int:
        """End-of-text id after the offset."""
        return self.text_offset + self.text_vocab - 1


# Fixed values (see module docstring).
STAGE1 = TokenLayout(codebook_size=1024, eoa=2048, text_offset=2049, text_vocab=513)
STAGE2 = TokenLayout(codebook_size=1024, eoa=1024, text_offset=1025, text_vocab=513)

# Byte-level text vocabulary used when no trained BPE ranks are given:
# 256 byte values plus end-of-text 256.
BYTE_EOT = 256
