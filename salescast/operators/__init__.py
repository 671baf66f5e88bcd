"""DataFrame-in, DataFrame-out steps of the forecasting pipeline."""
