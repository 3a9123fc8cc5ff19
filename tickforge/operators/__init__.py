"""DataFrame -> DataFrame operators. Every series operator takes the series
key (default ``ticker``) and order column (default ``t``) as arguments."""
