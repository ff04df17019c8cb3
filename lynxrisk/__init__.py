"""lynxrisk: behavioural-risk analytics on event data, as Spark DataFrame plans."""
