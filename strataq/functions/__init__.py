"""Text expressions, all built in."""

from .text import content_id, in_sample, normalised, only_letters, window_hashes, words

__all__ = ["content_id", "in_sample", "normalised", "only_letters", "window_hashes", "words"]
