"""SHA-256 of one byte stream in parts: what a part leaves behind is its state, from which another task goes on."""

from __future__ import annotations

import ctypes

#: Bytes of OpenSSL's SHA256_CTX, with room to spare.
STATE = 128


def library() -> ctypes.CDLL | None:
    """The library behind hashlib, whose objects can't be sent; None where it doesn't show its functions."""
    try:
        import _hashlib

        found = ctypes.CDLL(_hashlib.__file__)
        found.SHA256_Init, found.SHA256_Update, found.SHA256_Final  # noqa: B018  looks them up
    except (ImportError, OSError, AttributeError):
        return None
    found.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
    return found


class Chained:
    """A digest that goes on from the state of another; b'' is the beginning."""

    def __init__(self, state: bytes = b"") -> None:
        self.library, self.held = library(), ctypes.create_string_buffer(state, STATE)
        if not state:
            self.library.SHA256_Init(self.held)

    def update(self, data: bytes) -> None:
        self.library.SHA256_Update(self.held, data, len(data))

    def state(self) -> bytes:
        return self.held.raw

    def hexdigest(self) -> str:
        out, end = ctypes.create_string_buffer(32), ctypes.create_string_buffer(self.held.raw, STATE)
        self.library.SHA256_Final(out, end)
        return out.raw.hex()
