"""Readers, codecs and the fixture view."""
from allelic.sources.fixture import nest_snp, snps_from_events  # noqa: F401
