from strata.sources.files import SUPPORTED_FORMATS, read_source

__all__ = ["SUPPORTED_FORMATS", "read_source"]
