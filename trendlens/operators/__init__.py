"""DataFrame -> DataFrame operators (P*, A*, G*, J*, O*, X*)."""

from . import clean, joins, profile, rank, sampling, tags, topk

__all__ = ["clean", "joins", "profile", "rank", "sampling", "tags", "topk"]
