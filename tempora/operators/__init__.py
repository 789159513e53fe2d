"""DataFrame -> DataFrame operators. Signatures follow ``op(df, *dims, **params)``."""
