from .landing import stream_landing  # noqa: F401
