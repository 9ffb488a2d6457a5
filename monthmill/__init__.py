"""DataFrame jobs for daily slices, monthly activity features, market models and pipeline logs."""
