"""giftlink: donation-transaction ingest and donor record linkage on Spark.

Entry points:

* ``giftlink.plans.pipeline.run`` — the monthly job: feed exports -> canonical
  transactions -> schedules -> best CRM match -> action flags;
* ``giftlink.plans.linkage.Linkage`` — the linkage job on its own (pools,
  parameters, pairs, scores, best match);
* ``giftlink.plans.feeds`` — one normaliser per giving platform;
* ``giftlink.sources`` — readers for the exports and CRM tables, the CSV sink;
* ``giftlink.session`` — session defaults and ``materialize``.
"""
