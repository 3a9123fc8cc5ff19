"""tickforge: per-ticker time-series features (bars, proxies, news, indicators,
text embeddings, model prep and forecasting) as Spark DataFrame plans."""

from tickforge.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
