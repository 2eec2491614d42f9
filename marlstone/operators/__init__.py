"""DataFrame-to-DataFrame operators: normalize, rules, resolve, state, gates."""
