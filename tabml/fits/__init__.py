"""Many fits in one pass.

A search, a learning curve or a stack needs the same learner fitted on many
parts of one table. Here all these fits advance together: a Spark job adds up
what every fit needs next (histograms of open tree nodes, gradient steps,
accuracies), so the number of scans depends on depth, rounds or epochs, not on
the number of fits.
"""
