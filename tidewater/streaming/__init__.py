"""Structured Streaming: sources (S7-S11) and jobs.

Every job is ``readStream`` -> batch operators -> ``foreachBatch`` sink,
so a stream and a batch run over the same rows give the same answer.
Sinks are idempotent per batch id (a replayed micro-batch overwrites its
own output partition), which together with the checkpoint gives
exactly-once results across executor and driver restarts.
"""
