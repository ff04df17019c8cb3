"""The layers built from the operators: silver, features, weekly risk, checks, reports."""
