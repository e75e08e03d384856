"""DataFrame -> DataFrame operators (cleaning, measures, forecast, reports)."""
