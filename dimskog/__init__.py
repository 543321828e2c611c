"""dimskog: span detection, reconciliation and rewriting of sensitive text on Spark."""
