"""Defaults shared by the plans and registered queries."""

# fixed values: behaviour of the source project that results must reproduce
RUN_LABEL_FORMAT = "lstm_%d_%d_%.2f_%.2f"  # run label: lstm units, dense units, two dropout rates
CONVERTED_SUFFIX = "-converted.tfrecord"   # output name of a converted shard, after its base name
SEARCH_PAGE_SIZE = 50                      # results per search page (caps the place count too)
SEARCH_RADIUS_M = 1000.0                   # search radius around a place, metres
LABEL_SLOTS = 10                           # label vector width in effect
SEQUENCE_STEPS = 10                        # sequence length in effect
EARLY_STOP_PATIENCE = 3                    # epochs without improvement before stopping
VALIDATION_RATIO = 0.2                     # share of rows held out
EPOCHS = 10                                # epochs of the distributed training script
BATCH_SIZE = 32                            # mini-batch size of the distributed training script
