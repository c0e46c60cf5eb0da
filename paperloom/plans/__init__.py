"""Multi-step plans: global order, greedy packing, folder trees."""
